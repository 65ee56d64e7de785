"""DuckDB statements with the same results as the registered queries.

Written from the definitions, not from the Spark code: distances join pairs of
rows, hashed words are counted row by row, the spanning tree grows by Prim.
"""

from __future__ import annotations

# The code points that count as white space.
_SPACES = [*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
_WS = "concat(" + ", ".join(f"chr({c})" for c in _SPACES) + ")"

# Name, min_cluster_size and min_samples of the settings that are compared.
_SETTINGS = (
    ("baseline (min_cluster_size=30)", 30, None),
    ("coarser A (min_cluster_size=50, min_samples=15)", 50, 15),
    ("coarser B (min_cluster_size=75, min_samples=20)", 75, 20),
    ("coarser C (min_cluster_size=100, min_samples=30)", 100, 30),
)

_PROMPT_HEAD = (
    "The messages below were written to a support desk. They were put in one group because "
    "they mean nearly the same. Messages from the group:\n\n"
)
_PROMPT_TAIL = (
    '\n\nAnswer with one JSON object and nothing else. Its key "label" holds a category name '
    'of 3 to 6 words, its key "description" holds one sentence on what the messages ask for.'
)
_BREAK = r"'[^\p{L}\p{N}]+'"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_CLEAN = f"""
clean AS (
  SELECT doc_id, stripped AS text, lang, source, n_chars
  FROM (SELECT *, trim(text, {_WS}) AS stripped FROM documents)
  WHERE length(stripped) > 0
)"""

_DOCS = f"""{_CLEAN},
docs AS (
  SELECT doc_id, text, lang, source, n_chars
  FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS nth FROM clean)
  WHERE nth = 1
)"""

_BY_LANGUAGE = f"""{_DOCS},
assigned AS (
  SELECT *, CAST(CASE WHEN n_chars < 300 THEN -1 ELSE dense_rank() OVER (ORDER BY lang) - 1 END AS INTEGER)
         AS cluster_id
  FROM docs
)"""

_BY_LENGTH = f"""{_DOCS},
assigned AS (
  SELECT *, CAST(CASE WHEN n_chars < 1000 THEN 0 WHEN n_chars < 3000 THEN 1 ELSE 2 END AS INTEGER) AS cluster_id
  FROM docs
)"""

_M = "4294967296"

# 32-bit Murmur3 with seed 42 over the UTF-8 bytes, in unsigned arithmetic.
_HASHED = rf"""
words AS (
  SELECT doc_id, list_filter(string_split_regex(lower(text), {_BREAK}), lambda w: w <> '') AS w FROM docs
),
grams AS (
  SELECT doc_id, unnest(w) AS gram FROM words
  UNION ALL
  SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
),
counted AS (SELECT doc_id, gram, count(*) AS tf FROM grams GROUP BY ALL),
hexed AS (SELECT gram, hex(encode(gram)) AS x FROM (SELECT DISTINCT gram FROM counted)),
bytes AS (
  SELECT gram, list_transform(range(0, length(x) // 2),
      lambda i: CAST((instr('0123456789ABCDEF', substr(x, 2 * i + 1, 1)) - 1) * 16
              + instr('0123456789ABCDEF', substr(x, 2 * i + 2, 1)) - 1 AS UBIGINT)) AS b
  FROM hexed
),
blocks AS (
  SELECT gram, CAST(len(b) AS UBIGINT) AS n,
    list_transform(range(0, len(b) // 4),
      lambda i: b[4*i+1] + 256 * b[4*i+2] + 65536 * b[4*i+3] + 16777216 * b[4*i+4]) AS k,
    coalesce(b[4*(len(b)//4)+1], 0) + 256 * coalesce(b[4*(len(b)//4)+2], 0)
      + 65536 * coalesce(b[4*(len(b)//4)+3], 0) AS rest
  FROM bytes
),
times1 AS (
  SELECT gram, n, list_transform(list_append(k, CAST(rest AS UBIGINT)),
    lambda v: (CAST(v AS UBIGINT) * 3432918353::UBIGINT) % {_M}::UBIGINT) AS k FROM blocks
),
mixed AS (
  SELECT gram, n, list_transform(k,
    lambda v: (((v * 32768::UBIGINT) % {_M}::UBIGINT + v // 131072::UBIGINT) * 461845907::UBIGINT)
              % {_M}::UBIGINT) AS k
  FROM times1
),
body AS (
  SELECT gram, n, k[len(k)] AS rest,
    list_reduce(list_prepend(42::UBIGINT, k[1:len(k)-1]),
      lambda h, v: ((((xor(h, v) * 8192::UBIGINT) % {_M}::UBIGINT) + xor(h, v) // 524288::UBIGINT) * 5::UBIGINT
                    + 3864292196::UBIGINT) % {_M}::UBIGINT) AS h
  FROM mixed
),
end0 AS (SELECT gram, xor(xor(h, rest), n) AS h FROM body),
end1 AS (SELECT gram, (xor(h, h // 65536::UBIGINT) * 2246822507::UBIGINT) % {_M}::UBIGINT AS h FROM end0),
end2 AS (SELECT gram, (xor(h, h // 8192::UBIGINT) * 3266489909::UBIGINT) % {_M}::UBIGINT AS h FROM end1),
end3 AS (SELECT gram, CAST(xor(h, h // 65536::UBIGINT) AS BIGINT) AS h FROM end2),
slots AS (
  SELECT gram, ((CASE WHEN h >= 2147483648 THEN h - {_M} ELSE h END) % 768 + 768) % 768 AS slot FROM end3
),
per_slot AS (SELECT doc_id, slot, sum(tf) AS tf FROM counted JOIN slots USING (gram) GROUP BY ALL),
per_bucket AS (
  SELECT doc_id, slot % 384 AS bucket,
         coalesce(sum(ln(1 + tf)) FILTER (WHERE slot < 384), 0)
         - coalesce(sum(ln(1 + tf)) FILTER (WHERE slot >= 384), 0) AS v
  FROM per_slot GROUP BY ALL
),
hashed AS (
  SELECT doc_id, CAST(bucket AS INTEGER) AS bucket,
         CAST(CAST(v / sqrt(sum(v * v) OVER (PARTITION BY doc_id)) AS FLOAT) AS DOUBLE) AS value
  FROM per_bucket WHERE v <> 0
)"""

_NEAR_DOCS = """
filled AS (
  SELECT a.doc_id, a.cluster_id, d.bucket, coalesce(h.value, 0) AS value
  FROM (SELECT doc_id, cluster_id FROM assigned WHERE cluster_id <> -1) a
  CROSS JOIN (SELECT unnest(range(0, 384)) AS bucket) d
  LEFT JOIN hashed h ON h.doc_id = a.doc_id AND h.bucket = d.bucket
),
means AS (SELECT cluster_id, bucket, avg(value) AS mean FROM filled GROUP BY ALL),
away AS (
  SELECT cluster_id, doc_id, sqrt(sum((value - mean) * (value - mean))) AS dist
  FROM filled JOIN means USING (cluster_id, bucket) GROUP BY ALL
),
nearest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY round(dist, 9), doc_id) AS nth FROM away
  ) WHERE nth <= 8
),
sizes AS (SELECT cluster_id, count(*) AS size FROM assigned WHERE cluster_id <> -1 GROUP BY ALL)"""

_TERMS = f"""
tokens AS (
  SELECT cluster_id, unnest(list_filter(string_split_regex(lower(text), {_BREAK}), lambda w: w <> '')) AS term
  FROM assigned WHERE cluster_id <> -1
),
tf AS (SELECT cluster_id, term, count(*) AS tf FROM tokens GROUP BY ALL),
total AS (SELECT term, sum(tf) AS f FROM tf GROUP BY ALL),
mean_words AS (SELECT sum(tf) / count(DISTINCT cluster_id) AS a FROM tf),
scored AS (
  SELECT cluster_id, term, round(tf * ln(1 + (SELECT a FROM mean_words) / f), 6) AS score
  FROM tf JOIN total USING (term)
),
terms AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY score DESC, term) AS rank FROM scored
  ) WHERE rank <= 5
),
names AS (
  SELECT cluster_id, string_agg(term, ' / ' ORDER BY rank) AS label,
         'Messages about ' || string_agg(term, ', ' ORDER BY rank) AS description
  FROM terms GROUP BY ALL
)"""

_VECTORS = """
v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, CASE WHEN label = 9 THEN -1 ELSE label END AS cluster_id
  FROM embeddings
)"""

_PAIRS = f"""{_VECTORS},
pairs AS (
  SELECT a.vec_id, b.vec_id AS other, a.cluster_id AS own, b.cluster_id AS theirs, list_distance(a.e, b.e) AS dist
  FROM v a JOIN v b ON a.vec_id <> b.vec_id
)"""

_KNN = f"""{_PAIRS},
knn AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, other) AS rank FROM pairs
  ) WHERE rank <= 5
),
core AS (SELECT vec_id, max(dist) AS core FROM knn GROUP BY ALL)"""


# Grows the spanning tree of ``reach`` (x, y, w), ties by (w, least id, greatest id).
_PRIM = """
grown AS (
  SELECT y, x AS link, w, false AS taken, 0 AS step
  FROM reach WHERE x = (SELECT min(x) FROM reach)
  UNION ALL
  (WITH open AS (SELECT * FROM grown WHERE NOT taken),
   pick AS (SELECT * FROM open ORDER BY w, least(y, link), greatest(y, link) LIMIT 1)
   SELECT y, link, w, true AS taken, step + 1 FROM pick
   UNION ALL
   SELECT open.y,
          CASE WHEN (reach.w, least(reach.x, reach.y), greatest(reach.x, reach.y))
                    < (open.w, least(open.y, open.link), greatest(open.y, open.link))
               THEN reach.x ELSE open.link END,
          least(reach.w, open.w), false, open.step + 1
   FROM open, pick, reach
   WHERE open.y <> pick.y AND reach.x = pick.y AND reach.y = open.y)
),
mst AS (SELECT least(y, link) AS a, greatest(y, link) AS b, w FROM grown WHERE taken)"""


def _density(points: str, min_cluster_size: int, min_samples: int) -> str:
    """``density_labels`` (id, cluster_id) from ``points`` (id, e).

    The tree's edges are merged one at a time; each step keeps every point's
    component, the cluster of that component, and where the point left.
    """
    return f"""
gaps AS (SELECT a.id AS x, b.id AS y, list_distance(a.e, b.e) AS d FROM {points} a JOIN {points} b ON a.id <> b.id),
cored AS (
  SELECT x AS id, max(d) AS core
  FROM (SELECT *, row_number() OVER (PARTITION BY x ORDER BY d, y) AS nth FROM gaps)
  WHERE nth <= {min_samples} GROUP BY x
),
reach AS (
  SELECT x, y, greatest(d, mine.core, theirs.core) AS w
  FROM gaps JOIN cored mine ON mine.id = x JOIN cored theirs ON theirs.id = y
), {_PRIM},
edges AS (SELECT a, b, w, row_number() OVER (ORDER BY w, a, b) AS k FROM mst),
replay AS (
  SELECT 0::BIGINT AS step, id AS v, id AS comp, NULL::BIGINT AS cl, NULL::BIGINT AS exit_cl, NULL::DOUBLE AS exit_w
  FROM {points}
  UNION ALL
  (WITH cur AS (SELECT * FROM replay),
   ends AS (
     SELECT k, w, ra.comp AS ca, rb.comp AS cb, ra.cl AS cla, rb.cl AS clb
     FROM edges JOIN cur ra ON ra.v = a JOIN cur rb ON rb.v = b WHERE k = ra.step + 1
   ),
   pick AS (
     SELECT k, w, ca, cb,
            CASE WHEN cla IS NOT NULL AND clb IS NOT NULL THEN k
                 WHEN cla IS NOT NULL THEN cla
                 WHEN clb IS NOT NULL THEN clb
                 WHEN (SELECT count(*) FROM cur, ends e WHERE comp IN (e.ca, e.cb)) >= {min_cluster_size} THEN k
            END AS now
     FROM ends
   )
   SELECT k, v,
          CASE WHEN comp IN (ca, cb) THEN least(ca, cb) ELSE comp END,
          CASE WHEN comp IN (ca, cb) THEN now ELSE cl END,
          CASE WHEN comp IN (ca, cb) AND cl IS NULL THEN now ELSE exit_cl END,
          CASE WHEN comp IN (ca, cb) AND cl IS NULL AND now IS NOT NULL THEN w ELSE exit_w END
   FROM cur, pick)
),
last AS (SELECT * FROM replay WHERE step = (SELECT max(k) FROM edges)),
lives AS (SELECT cl AS c, step, count(*) AS size FROM replay WHERE cl IS NOT NULL GROUP BY ALL),
ended AS (
  SELECT c, size, edges.k AS parent, 1 / greatest(edges.w, 1e-12) AS birth
  FROM (SELECT c, max(step) AS step, arg_max(size, step) AS size FROM lives GROUP BY c)
  LEFT JOIN edges ON edges.k = step + 1
),
sums AS (
  SELECT c, sum(n) AS n, sum(s) AS s FROM (
    SELECT exit_cl AS c, 1 AS n, 1 / greatest(exit_w, 1e-12) AS s FROM last
    UNION ALL SELECT parent, size, size * birth FROM ended WHERE parent IS NOT NULL
  ) GROUP BY c
),
tree AS (
  SELECT c, parent, s - n * coalesce(birth, 0) AS own, row_number() OVER (ORDER BY c) AS nth
  FROM ended JOIN sums USING (c)
),
weighed AS (
  SELECT 0::BIGINT AS i, c, parent, own, nth, 0::DOUBLE AS below FROM tree
  UNION ALL
  (WITH cur AS (SELECT * FROM weighed),
   pick AS (SELECT parent AS up, greatest(own, below) AS best FROM cur WHERE nth = i + 1)
   SELECT i + 1, c, parent, own, nth, below + CASE WHEN c = up THEN best ELSE 0 END FROM cur, pick)
),
kept AS (SELECT c FROM weighed WHERE i = (SELECT count(*) FROM tree) AND own >= below AND parent IS NOT NULL),
above AS (
  SELECT c, c AS up FROM tree
  UNION ALL
  SELECT above.c, tree.parent FROM above JOIN tree ON tree.c = above.up WHERE tree.parent IS NOT NULL
),
chosen AS (SELECT above.c, max(up) AS sel FROM above JOIN kept ON kept.c = up GROUP BY above.c),
placed AS (SELECT v, sel FROM last LEFT JOIN chosen ON chosen.c = exit_cl),
numbers AS (
  SELECT sel, row_number() OVER (ORDER BY least_id) - 1 AS number
  FROM (SELECT sel, min(v) AS least_id FROM placed WHERE sel IS NOT NULL GROUP BY sel)
),
density_labels AS (
  SELECT v AS id, CAST(coalesce(number, -1) AS INTEGER) AS cluster_id FROM placed LEFT JOIN numbers USING (sel)
)"""


def _agreement(cells: str, by: str = "") -> str:
    """``scores`` with ari, nmi, n_evaluated from ``cells`` (a, b, n); no rows give NaN, by definition."""
    lead = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    join = f"USING ({by})" if by else "ON true"
    return f"""
ma AS (SELECT {lead}a, CAST(sum(n) AS DOUBLE) AS n FROM {cells} GROUP BY ALL),
mb AS (SELECT {lead}b, CAST(sum(n) AS DOUBLE) AS n FROM {cells} GROUP BY ALL),
sab AS (SELECT {lead}sum(n) AS n, sum(n * (n - 1) / 2.0) AS p, count(*) AS c
        FROM (SELECT * REPLACE (CAST(n AS DOUBLE) AS n) FROM {cells}) {group}),
total AS (SELECT {lead}CAST(sum(n) AS DOUBLE) AS t FROM {cells} {group}),
sa AS (SELECT {lead}sum(n * (n - 1) / 2.0) AS pa, -sum(n / t * ln(n / t)) AS ha, count(*) AS ca FROM ma JOIN total {join} {group}),
sb AS (SELECT {lead}sum(n * (n - 1) / 2.0) AS pb, -sum(n / t * ln(n / t)) AS hb, count(*) AS cb FROM mb JOIN total {join} {group}),
shared AS (
  SELECT {lead}sum(x.n / t * ln((x.n / t) / ((ma.n / t) * (mb.n / t)))) AS mi
  FROM {cells} x JOIN ma USING ({lead}a) JOIN mb USING ({lead}b) JOIN total {join} {group}
),
scores AS (
  SELECT {lead}CAST(n AS BIGINT) AS n_evaluated,
    CASE WHEN c = 0 THEN 'NaN'::DOUBLE WHEN c = ca AND c = cb THEN 1.0
         ELSE (p - pa * pb / (n * (n - 1) / 2)) / ((pa + pb) / 2 - pa * pb / (n * (n - 1) / 2)) END AS ari,
    CASE WHEN c = 0 THEN 'NaN'::DOUBLE WHEN c = ca AND c = cb THEN 1.0
         ELSE greatest(mi, 0) / ((ha + hb) / 2) END AS nmi
  FROM sab JOIN sa {join} JOIN sb {join} JOIN shared {join}
)"""


def _silhouette(rows: str, power: int = 1) -> str:
    """``score`` of the rows (vec_id, cluster_id, e), pair by pair; power 2 for squared distances."""
    return f"""
s AS ({rows}),
sums AS (
  SELECT a.vec_id, a.cluster_id AS own, b.cluster_id AS theirs, sum(list_distance(a.e, b.e) ** {power}) AS d, count(*) AS n
  FROM s a JOIN s b ON a.vec_id <> b.vec_id GROUP BY ALL
),
inside AS (SELECT vec_id, d / n AS a FROM sums WHERE own = theirs),
outside AS (SELECT vec_id, min(d / n) AS b FROM sums WHERE own <> theirs GROUP BY ALL),
score AS (
  SELECT avg(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette,
         count(*) AS n_scored
  FROM outside LEFT JOIN inside USING (vec_id)
)"""


_DENSE = """
dense AS (
  SELECT doc_id AS id, list(coalesce(value, 0) ORDER BY bucket) AS e
  FROM (SELECT doc_id, bucket, value FROM docs CROSS JOIN (SELECT unnest(range(0, 384)) AS bucket)
        LEFT JOIN hashed USING (doc_id, bucket))
  GROUP BY doc_id
)"""


#: The first two principal axes by power iteration with orthogonal steps; rows are not centred when they are placed.
_AXES = """
cells AS (SELECT id, unnest(e) AS x, unnest(range(1, len(e) + 1)) AS dim FROM dense),
level AS (SELECT list(mean ORDER BY dim) AS m FROM (SELECT dim, avg(x) AS mean FROM cells GROUP BY dim)),
flat AS (SELECT id, list_transform(list_zip(e, m), lambda p: p[1] - p[2]) AS c FROM dense, level),
wide AS (SELECT dim AS a, other AS b, avg(x * y) AS v FROM (
  SELECT unnest(range(1, len(c) + 1)) AS dim, unnest(c) AS x, c FROM flat), LATERAL (SELECT unnest(c) AS y, unnest(range(1, len(c) + 1)) AS other)
  GROUP BY ALL),
square AS (SELECT list(row ORDER BY a) AS s FROM (SELECT a, list(v ORDER BY b) AS row FROM wide GROUP BY a)),
turned AS (
  SELECT 0 AS step, list_transform(range(1, len(s) + 1), lambda i: sin(i * 1.7) + 0.1) AS u, list_transform(range(1, len(s) + 1), lambda i: cos(i * 2.3)) AS w
  FROM square
  UNION ALL
  SELECT step + 1, list_transform(su, lambda v: v / list_distance(su, list_transform(su, lambda z: 0.0))), list_transform(ow, lambda v: v / list_distance(ow, list_transform(ow, lambda z: 0.0)))
  FROM (
    SELECT step, su, list_transform(list_zip(sw, su), lambda p: p[1] - p[2] * list_dot_product(sw, su) / list_dot_product(su, su)) AS ow
    FROM (
      SELECT step, list_transform(s, lambda r: list_dot_product(r, u)) AS su, list_transform(s, lambda r: list_dot_product(r, w)) AS sw
      FROM turned, square WHERE step < 300
    )
  )
),
axes AS (
  SELECT list_transform(u, lambda v: v * sign(u[list_position(list_transform(u, lambda z: abs(z)), list_max(list_transform(u, lambda z: abs(z))))])) AS u,
         list_transform(w, lambda v: v * sign(w[list_position(list_transform(w, lambda z: abs(z)), list_max(list_transform(w, lambda z: abs(z))))])) AS w
  FROM turned WHERE step = 300
)
SELECT id, round(list_dot_product(e, u), 4) + 0.0 AS x, round(list_dot_product(e, w), 4) + 0.0 AS y, 'pca' AS method FROM dense, axes"""


def _setting(name: str, size: int, samples: int | None) -> str:
    """One row of the settings sweep over hashed documents, scored against their language."""
    shown = "" if samples is None else samples
    return f"""(WITH RECURSIVE {_DOCS}, {_HASHED}, {_DENSE}, {_density("dense", size, samples or size)},
    counts AS (
      SELECT count(DISTINCT cluster_id) FILTER (WHERE cluster_id <> -1) AS n_clusters,
             count(*) FILTER (WHERE cluster_id = -1) AS n_noise, count(*) AS n
      FROM density_labels
    ),
    cells AS (SELECT cluster_id AS a, lang AS b, count(*) AS n FROM density_labels JOIN docs ON doc_id = id
              WHERE cluster_id <> -1 GROUP BY ALL), {_agreement("cells")},
    inner_rows AS (SELECT id, cluster_id, e FROM density_labels JOIN dense USING (id) WHERE cluster_id <> -1),
    away AS (
      SELECT a.id, a.cluster_id AS own, b.cluster_id AS theirs, sum(list_distance(a.e, b.e) ** 2) AS d, count(*) AS n
      FROM inner_rows a JOIN inner_rows b ON a.id <> b.id GROUP BY ALL
    ),
    near AS (SELECT id, min(d / n) AS b FROM away WHERE own <> theirs GROUP BY ALL),
    home AS (SELECT id, d / n AS a FROM away WHERE own = theirs),
    width AS (
      SELECT avg(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette
      FROM near LEFT JOIN home USING (id)
    )
    SELECT {_quoted(name)} AS name, {size} AS min_cluster_size, '{shown}' AS min_samples, n_clusters, n_noise,
           round(n_noise / n, 6) AS noise_fraction,
           round(coalesce((SELECT silhouette FROM width), 'NaN'::DOUBLE), 6) AS silhouette,
           n - n_noise AS n_scored,
           round(coalesce((SELECT ari FROM scores), 'NaN'::DOUBLE), 6) AS ari,
           round(coalesce((SELECT nmi FROM scores), 'NaN'::DOUBLE), 6) AS nmi
    FROM counts)"""


def _kmeans(ks: list[int]) -> str:
    """``centres`` (k, cs) when they stay and ``kmeans_labels`` (k, id, cluster_id) over ``dense``.

    The centres for a smaller k are the first ones for a larger k.
    """
    draw = "(CAST('0x' || substr(md5('42:' || {} || ':' || id), 1, 13) AS BIGINT) + 0.5) / 4503599627370496"
    return f"""
rounds AS (
  SELECT 0 AS round, [id] AS ids, [e] AS cs FROM dense QUALIFY row_number() OVER (ORDER BY md5('42:' || id), id) = 1
  UNION ALL
  SELECT round + 1, list_concat(any_value(ids), coalesce(list(id ORDER BY id) FILTER (picked), [])),
         list_concat(any_value(cs), coalesce(list(e ORDER BY id) FILTER (picked), []))
  FROM (
    SELECT *, gap > 0 AND draw * sum(gap) OVER () < {2 * max(ks)} * gap AS picked
    FROM (
      SELECT round, ids, cs, id, e, {draw.format("(-round - 1)")} AS draw,
             list_min(list_transform(cs, lambda c: round(list_distance(c, e) ** 2, 9))) AS gap
      FROM rounds, dense WHERE round < 5
    )
  )
  GROUP BY round
),
drawn AS (SELECT unnest(ids) AS id, unnest(cs) AS e, unnest(range(1, len(ids) + 1)) AS place FROM rounds WHERE round = 5),
start AS (
  SELECT drawn.*, weight
  FROM drawn JOIN (
    SELECT list_position(gaps, list_min(gaps)) AS place, count(*) AS weight
    FROM (SELECT list_transform(cs, lambda c: round(list_distance(c, dense.e) ** 2, 9)) AS gaps FROM dense, rounds WHERE round = 5)
    GROUP BY 1
  ) USING (place)
),
spread AS (SELECT 0.0001 * avg(v) AS least FROM (SELECT var_pop(x) AS v FROM (SELECT unnest(e) AS x, unnest(range(0, len(e))) AS dim FROM dense) GROUP BY dim)),
pick AS (
  SELECT 1 AS step, [e] AS cs FROM start QUALIFY row_number() OVER (ORDER BY ln({draw.format("0")}) / weight DESC, place) = 1
  UNION ALL
  SELECT step + 1, list_append(any_value(cs), arg_min(e, potential))
  FROM (
    SELECT step, id, any_value(cs) AS cs, any_value(e) AS e, sum(weight * least(gap, list_distance(e, other) ** 2)) AS potential
    FROM (
      SELECT c.step, c.id, c.cs, c.e, s.e AS other, s.weight, list_min(list_transform(c.cs, lambda x: list_distance(x, s.e) ** 2)) AS gap
      FROM start s, (
        SELECT step, cs, id, e
        FROM (
          SELECT step, cs, id, e, place, weight, list_min(list_transform(cs, lambda c: list_distance(c, start.e) ** 2)) AS gap,
                 {draw.format("step")} AS draw
          FROM pick, start WHERE step < {max(ks)}
        )
        WHERE gap > 0
        QUALIFY row_number() OVER (ORDER BY ln(draw) / (gap * weight) DESC, place) <= 8
      ) c
    )
    GROUP BY step, id
  )
  GROUP BY step
),
moved AS (
  SELECT 0 AS step, k, list_slice((SELECT arg_max(cs, step) FROM pick), 1, k) AS cs, CAST('inf' AS DOUBLE) AS moved
  FROM (SELECT unnest({ks}) AS k) WHERE k < (SELECT count(*) FROM dense) OR {len(ks)} = 1
  UNION ALL
  SELECT step, k, new, list_sum(list_transform(list_zip(cs, new), lambda p: list_distance(p[1], p[2]) ** 2))
  FROM (
  SELECT moved.step + 1 AS step, moved.k AS k, cs, list_transform(range(1, len(cs) + 1), lambda i: coalesce(means[i], cs[i])) AS new
  FROM moved JOIN (
    SELECT k, map_from_entries(list((own, mean))) AS means
    FROM (
      SELECT k, own, list(x ORDER BY dim) AS mean
      FROM (
        SELECT k, own, dim, avg(x) AS x
        FROM (
          SELECT k, list_position(gaps, list_min(gaps)) AS own, unnest(e) AS x, unnest(range(0, len(e))) AS dim
          FROM (
            SELECT k, e, list_transform(cs, lambda c: round(list_distance(c, dense.e) ** 2, 9)) AS gaps
            FROM moved, dense WHERE moved > (SELECT least FROM spread)
          )
        )
        GROUP BY k, own, dim
      )
      GROUP BY k, own
    )
    GROUP BY k
  ) USING (k)
  WHERE moved.step < 300 AND moved.moved > (SELECT least FROM spread)
  )
),
centres AS (SELECT k, arg_max(cs, step) AS cs, max(step) AS steps, arg_max(moved, step) <= (SELECT least FROM spread) AS converged FROM moved GROUP BY k),
kmeans_labels AS (
  SELECT k, id, CAST(list_position(gaps, list_min(gaps)) - 1 AS INTEGER) AS cluster_id
  FROM (SELECT k, id, list_transform(cs, lambda c: round(list_distance(c, dense.e) ** 2, 9)) AS gaps FROM centres, dense)
)"""


_CATALOGUE = """
ex AS (SELECT cluster_id, string_agg(text, ' || ' ORDER BY nth) AS examples
       FROM nearest JOIN docs USING (doc_id) WHERE nth <= 5 GROUP BY ALL)
SELECT cluster_id, label, description, size,
       round(100.0 * size / (SELECT count(*) FROM assigned), 6) AS share, examples
FROM sizes JOIN names USING (cluster_id) JOIN ex USING (cluster_id)"""


def statements() -> dict[str, str]:
    out = {
        "clean_text": f"WITH {_CLEAN} SELECT doc_id, text FROM clean",
        "dedupe_first": f"WITH {_DOCS} SELECT doc_id, text, lang, source FROM docs",
        "label_conflicts": f"""WITH {_CLEAN}
            SELECT count(*) AS n_texts, count(*) FILTER (WHERE nl > 1 OR ns > 1) AS n_conflicting
            FROM (SELECT count(DISTINCT lang) AS nl, count(DISTINCT source) AS ns FROM clean GROUP BY text)""",
        "dense_id": f"WITH {_DOCS} SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS id FROM docs",
        "heldout_split": f"WITH {_DOCS} SELECT doc_id, lang AS category, source AS intent FROM docs",
        "heldout_texts": f"WITH {_DOCS} SELECT doc_id, text FROM docs",
        "seeded_sample": "SELECT doc_id FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 200",
        "label_profile": f"""WITH {_DOCS}
            SELECT count(DISTINCT lang) AS n_category, count(DISTINCT source) AS n_intent,
                   (SELECT string_agg(lang, ',' ORDER BY lang) FROM (SELECT DISTINCT lang FROM docs)) AS categories
            FROM docs""",
        "embed_hash": f"WITH {_DOCS}, {_HASHED} SELECT doc_id, bucket, round(value, 6) AS value FROM hashed",
        "cluster_counts": f"""WITH {_BY_LANGUAGE}
            SELECT count(DISTINCT cluster_id) FILTER (WHERE cluster_id <> -1) AS n_clusters,
                   count(*) FILTER (WHERE cluster_id = -1) AS n_noise, count(*) AS n_total,
                   round(count(*) FILTER (WHERE cluster_id = -1) / count(*), 6) AS noise_fraction
            FROM assigned""",
        "cluster_sizes": f"""WITH {_BY_LANGUAGE}
            SELECT cluster_id, count(*) AS size FROM assigned WHERE cluster_id <> -1 GROUP BY ALL""",
        "contingency": f"""WITH {_BY_LANGUAGE}
            SELECT cluster_id AS a, source AS b, count(*) AS n FROM assigned WHERE cluster_id <> -1 GROUP BY ALL""",
        "external_ari": f"""WITH {_BY_LANGUAGE},
            cells AS (SELECT cluster_id AS a, source AS b, count(*) AS n FROM assigned
                      WHERE cluster_id <> -1 GROUP BY ALL), {_agreement("cells")}
            SELECT round(ari, 6) AS ari, n_evaluated, (SELECT count(*) FROM assigned) AS n_total FROM scores""",
        "external_nmi": f"""WITH {_BY_LENGTH},
            cells AS (SELECT cluster_id AS a, lang AS b, count(*) AS n FROM assigned
                      WHERE cluster_id <> -1 GROUP BY ALL), {_agreement("cells")}
            SELECT round(nmi, 6) AS nmi, n_evaluated, (SELECT count(*) FROM assigned) AS n_total FROM scores""",
        "external_partial": f"""WITH {_BY_LANGUAGE},
            cells AS (SELECT cluster_id AS a, quality AS b, count(*) AS n FROM assigned JOIN labels USING (doc_id)
                      WHERE cluster_id <> -1 AND quality IS NOT NULL GROUP BY ALL), {_agreement("cells")}
            SELECT round(ari, 6) AS ari, round(nmi, 6) AS nmi, n_evaluated, (SELECT count(*) FROM assigned) AS n_total
            FROM scores""",
        "method_comparison": f"""WITH {_DOCS},
            both_ways AS (
              SELECT doc_id, lang, source, n_chars,
                     CASE WHEN n_chars < 300 THEN -1 ELSE dense_rank() OVER (ORDER BY lang) - 1 END AS c1,
                     CASE WHEN n_chars < 1000 THEN 0 WHEN n_chars < 3000 THEN 1 ELSE 2 END AS c2
              FROM docs
            ),
            stacked AS (
              SELECT 'a' AS method, 'own' AS scope, c1 AS a, lang, source FROM both_ways WHERE c1 <> -1
              UNION ALL SELECT 'a', 'shared', c1, lang, source FROM both_ways WHERE c1 <> -1
              UNION ALL SELECT 'b', 'own', c2, lang, source FROM both_ways
              UNION ALL SELECT 'b', 'shared', c2, lang, source FROM both_ways WHERE c1 <> -1
            ),
            cells AS (
              SELECT method || '|' || scope || '|category' AS g, a, lang AS b, count(*) AS n FROM stacked GROUP BY ALL
              UNION ALL
              SELECT method || '|' || scope || '|intent', a, source, count(*) FROM stacked GROUP BY ALL
            ), {_agreement("cells", "g")},
            parts AS (SELECT string_split(g, '|') AS k, ari, nmi, n_evaluated FROM scores),
            long AS (
              SELECT k[1] AS method, 'ari_vs_' || k[3] || '_' || k[2] AS metric, ari AS value FROM parts
              UNION ALL SELECT k[1], 'nmi_vs_' || k[3] || '_' || k[2], nmi FROM parts
              UNION ALL SELECT k[1], 'n_vs_' || k[3] || '_' || k[2], CAST(n_evaluated AS DOUBLE) FROM parts
              UNION ALL SELECT 'a', 'coverage', count(*) FILTER (WHERE c1 <> -1) / count(*) FROM both_ways
              UNION ALL SELECT 'b', 'coverage', 1.0
            )
            SELECT metric, round(max(value) FILTER (WHERE method = 'a'), 6) AS a,
                   round(max(value) FILTER (WHERE method = 'b'), 6) AS b
            FROM long GROUP BY ALL""",
        "centroids": f"""WITH {_VECTORS},
            items AS (SELECT cluster_id, unnest(e) AS x, unnest(range(0, len(e))) AS dim FROM v
                      WHERE cluster_id <> -1)
            SELECT CAST(cluster_id AS INTEGER) AS cluster_id, CAST(dim AS INTEGER) AS dim, round(avg(x), 6) AS mean
            FROM items GROUP BY ALL""",
        "representatives": f"""WITH {_VECTORS},
            items AS (SELECT vec_id, cluster_id, unnest(e) AS x, unnest(range(0, len(e))) AS dim FROM v
                      WHERE cluster_id <> -1),
            means AS (SELECT cluster_id, dim, avg(x) AS mean FROM items GROUP BY ALL),
            away AS (SELECT cluster_id, vec_id, sqrt(sum((x - mean) * (x - mean))) AS dist
                     FROM items JOIN means USING (cluster_id, dim) GROUP BY ALL)
            SELECT CAST(cluster_id AS INTEGER) AS cluster_id, CAST(rank AS INTEGER) AS rank, vec_id,
                   round(dist, 6) AS dist
            FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY round(dist, 9), vec_id) AS rank
                  FROM away)
            WHERE rank <= 8""",
        "silhouette_sampled": f"""WITH {_VECTORS}, {_silhouette(
            "SELECT * FROM v WHERE cluster_id <> -1 ORDER BY md5('42:' || vec_id), vec_id LIMIT 200")}
            SELECT round(silhouette, 6) AS silhouette, n_scored FROM score""",
        "silhouette_exact": f"""WITH {_VECTORS}, {_silhouette("SELECT * FROM v WHERE cluster_id <> -1")}
            SELECT round(silhouette, 6) AS silhouette, n_scored FROM score""",
        "silhouette_linear": f"""WITH {_VECTORS}, {_silhouette("SELECT * FROM v WHERE cluster_id <> -1", 2)}
            SELECT round(silhouette, 6) AS silhouette, n_scored FROM score""",
        "pairwise_knn": f"""WITH {_KNN}
            SELECT vec_id, CAST(rank AS INTEGER) AS rank, other, round(dist, 6) AS dist FROM knn""",
        "core_distance": f"WITH {_KNN} SELECT vec_id, round(core, 6) AS core FROM core",
        "mutual_reachability": f"""WITH {_KNN}
            SELECT knn.vec_id, CAST(rank AS INTEGER) AS rank, other,
                   round(greatest(dist, mine.core, theirs.core), 6) AS mrd
            FROM knn JOIN core mine ON mine.vec_id = knn.vec_id JOIN core theirs ON theirs.vec_id = other""",
        "hdbscan_mst": f"""WITH RECURSIVE {_KNN},
            reach AS (
              SELECT pairs.vec_id AS x, other AS y, greatest(dist, mine.core, theirs.core) AS w
              FROM pairs JOIN core mine ON mine.vec_id = pairs.vec_id JOIN core theirs ON theirs.vec_id = other
            ), {_PRIM}
            SELECT a, b, round(w, 6) AS w FROM mst""",
        "hdbscan_labels": f"""WITH RECURSIVE {_DOCS}, {_HASHED}, {_DENSE}, {_density("dense", 100, 30)}
            SELECT id, 'hdbscan' AS method, cluster_id FROM density_labels""",
        "hdbscan_sweep": " UNION ALL ".join(_setting(*s) for s in _SETTINGS),
        "keyword_labels": f"""WITH {_BY_LANGUAGE}, {_TERMS}
            SELECT cluster_id, CAST(rank AS INTEGER) AS rank, term, score FROM terms""",
        "label_requests": f"""WITH {_BY_LANGUAGE}, {_HASHED}, {_NEAR_DOCS}
            SELECT cluster_id, size, {_quoted(_PROMPT_HEAD)} || string_agg('- ' || text, chr(10) ORDER BY nth)
                   || {_quoted(_PROMPT_TAIL)} AS prompt
            FROM nearest JOIN docs USING (doc_id) JOIN sizes USING (cluster_id) GROUP BY ALL""",
        "cluster_catalogue": f"WITH {_BY_LANGUAGE}, {_HASHED}, {_NEAR_DOCS}, {_TERMS}, {_CATALOGUE}",
        "kmeans_assign": f"""WITH RECURSIVE {_DOCS}, {_HASHED}, {_DENSE}, {_kmeans([4])}
            SELECT id, 'kmeans' AS method, cluster_id FROM kmeans_labels""",
        "k_search_short": f"""WITH RECURSIVE {_DOCS}, {_HASHED}, {_DENSE}, {_kmeans([4, 8, 12])},
            apart AS (SELECT a.id, b.id AS other, list_distance(a.e, b.e) ** 2 AS d FROM dense a JOIN dense b ON a.id <> b.id),
            sums AS (
              SELECT mine.k, apart.id, mine.cluster_id AS own, theirs.cluster_id AS theirs, sum(d) AS d, count(*) AS n
              FROM apart JOIN kmeans_labels mine ON mine.id = apart.id
              JOIN kmeans_labels theirs ON theirs.id = other AND theirs.k = mine.k GROUP BY ALL
            ),
            near AS (SELECT k, id, min(d / n) AS b FROM sums WHERE own <> theirs GROUP BY ALL),
            home AS (SELECT k, id, d / n AS a FROM sums WHERE own = theirs),
            scored AS (
              SELECT k, count(*) AS n_scored, round(
                avg(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette
              FROM near LEFT JOIN home USING (k, id) GROUP BY k
            )
            SELECT CAST(k AS INTEGER) AS k, silhouette, n_scored, CAST(steps AS INTEGER) AS steps, converged
            FROM scored JOIN centres USING (k)""",
        "project_2d": f"""WITH RECURSIVE {_DOCS}, {_HASHED}, {_DENSE}, {_AXES}""",
        "discover": f"""WITH RECURSIVE {_DOCS}, {_HASHED}, {_DENSE}, {_kmeans([4])},
            assigned AS (SELECT docs.*, cluster_id FROM docs JOIN kmeans_labels ON id = doc_id),
            {_NEAR_DOCS}, {_TERMS}, {_CATALOGUE}""",
        "cluster_map": f"""WITH {_BY_LANGUAGE}, {_TERMS}
            SELECT doc_id, CAST(n_chars AS DOUBLE) AS x, CAST(doc_id AS DOUBLE) AS y, cluster_id,
                   cluster_id = -1 AS is_noise,
                   'cluster ' || cluster_id || ': ' || coalesce(label, 'noise') || '<br>' || left(text, 80)
                   || CASE WHEN length(text) > 80 THEN '...' ELSE '' END AS hover
            FROM assigned LEFT JOIN names USING (cluster_id)""",
        "cluster_map_bins": f"""WITH {_BY_LANGUAGE}
            SELECT CAST(floor(n_chars / 250.0) AS BIGINT) AS x_bin, CAST(floor(doc_id / 250.0) AS BIGINT) AS y_bin,
                   cluster_id, count(*) AS n
            FROM assigned GROUP BY ALL""",
        "kpi_report": f"""WITH {_BY_LANGUAGE}, {_HASHED}, {_DENSE},
            {_silhouette("SELECT doc_id AS vec_id, cluster_id, e FROM assigned JOIN dense ON id = doc_id WHERE cluster_id <> -1", 2)},
            cells AS (SELECT cluster_id AS a, source AS b, count(*) AS n FROM assigned
                      WHERE cluster_id <> -1 GROUP BY ALL),
            {_agreement("cells")},
            facts AS (SELECT count(*) AS n, count(DISTINCT cluster_id) FILTER (WHERE cluster_id <> -1) AS c,
                             count(*) FILTER (WHERE cluster_id = -1) AS noise FROM assigned),
            rows AS (
              SELECT 'n_samples' AS metric, CAST(n AS DOUBLE) AS value, 'neutral' AS band FROM facts
              UNION ALL SELECT 'n_clusters', c, 'neutral' FROM facts
              UNION ALL SELECT 'n_noise', noise, 'neutral' FROM facts
              UNION ALL SELECT 'noise_percent', 100.0 * noise / n,
                               CASE WHEN 100.0 * noise / n > 15 THEN 'warn' ELSE 'neutral' END FROM facts
              UNION ALL SELECT 'silhouette', silhouette,
                               CASE WHEN silhouette >= 0.5 THEN 'good' WHEN silhouette < 0.15 THEN 'warn'
                                    ELSE 'mid' END FROM score
              UNION ALL SELECT 'nmi', nmi,
                               CASE WHEN nmi >= 0.7 THEN 'good' WHEN nmi < 0.4 THEN 'warn' ELSE 'mid' END FROM scores
            )
            SELECT metric, round(value, 6) AS value, band FROM rows""",
    }
    return {name: sql.strip() for name, sql in out.items()}
