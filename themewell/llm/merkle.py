"""Merkle manifest of a table: levels of hashes by source, and proofs by a recursive query.

Each row is a leaf. Per source the leaves ascend by id; runs of ``RUN`` nodes
become their hash until one is left, the source's subroot, and the subroots
become one root in the same way. All levels above the leaves are stored as node
rows that name their parent: a node has the digests of its run side by side.

A proof is made by a Spark recursive query: every leaf climbs from its own run
to the root, one stored node a step, appends the siblings it meets (as the node
and its own place there) to its path and folds its digest, tampered or not, into
the next. Leaves of one run share all siblings above it, so the digests of a
path are written out once per run, and once more beside each leaf's own.

All leaves meet in the root, so a node is stored once for each chunk of ``CHUNK``
leaves below it, and a step joins by node and chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from themewell.llm.prefix import with_running_sums
from themewell.session import cut

RUN = 16  # nodes of a run
_BITS = 4  # of a place in a run
_DIGEST = 64  # characters of a digest
_LEVELS = 64  # node numbers are first leaf times this, plus the level
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

CHUNK = 4096  # leaves that may meet in one stored row, about

_NODES = "id long, parent long, place int, subroot string, run string, low long, high long"


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: dict[str, Column]) -> Column:
    """Hash of a row: its fields one after another, in the order of ``FIELDS``."""
    return F.sha2(F.concat(*[field(values[c]) for c in FIELDS]), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def every_fifth(doc_id: Column) -> Column:
    """Rows whose crc32 of the id in decimal can be divided by 5; never those without id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(doc_id, source, leaf, other): the hash of each row, and where ``tampered`` of its row with lower-cased text."""
    own = {"doc_id": docs["doc_id"].cast("long"), "n_chars": docs["n_chars"].cast("long")}
    own |= {c: docs[c].cast("string") for c in ("source", "lang", "text")}
    other = leaf(own | {"text": lower_ascii(own["text"])})
    whole = leaf(own)
    return docs.select(
        own["doc_id"].alias("doc_id"),
        own["source"].alias("source"),
        whole.alias("leaf"),
        (whole if tampered is None else F.when(tampered, other).otherwise(whole)).alias("other"),
    )


# ---- levels -----------------------------------------------------------------


def _node(first: Column, index: Column, level: int | Column) -> Column:
    """Number of the node over the ``index``-th node of the level below, where the run's tree starts at leaf ``first``."""
    level = F.lit(level) if isinstance(level, int) else level
    start = first + F.call_function("shiftleft", F.shiftright(index, _BITS), (_BITS * level).cast("int"))
    return start * _LEVELS + level


def _place(index: Column) -> Column:
    return index.bitwiseAND(F.lit(RUN - 1)).cast("int")


def _height(n: int) -> int:
    """Levels above ``n`` leaves."""
    height = 0
    while RUN**height < n:
        height += 1
    return height


def _above(level: DataFrame) -> DataFrame:
    """Nodes over the rows (up, place, digest, index, low, high, ...) of a level: id, digest, run and what all their children share."""
    own = ("up", "place", "digest", "index", "low", "high")
    shared = [F.first(c).alias(c) for c in level.columns if c not in own]
    # A run has RUN digests at most.
    digests = F.array_sort(F.collect_list(F.struct("place", "digest")))
    runs = level.groupBy(F.col("up").alias("id")).agg(
        F.array_join(F.transform(digests, lambda x: x["digest"]), "").alias("run"),
        F.shiftright(F.min("index"), _BITS).alias("index"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        *shared,
    )
    return runs.withColumn("digest", F.sha2("run", 256))


class Tree:
    """Stored levels: ``leaves`` (up, place, ...), ``nodes`` (``_NODES``; low and high are the first and last leaf below), ``root``."""

    def __init__(self, leaves: DataFrame, nodes: DataFrame, root: str | None) -> None:
        self.leaves, self.nodes, self.root = leaves, nodes, root


def build(hashed: DataFrame) -> Tree:
    """The levels over (doc_id, source, leaf, other), each written once.

    Rows without id come first in their source, rows of one id go by their hash.
    """
    spark = hashed.sparkSession
    tied = hashed.withColumns({"one": F.lit(1).cast("long"), "tie": F.monotonically_increasing_id()})
    ranked = with_running_sums(cut(tied), ["source", "doc_id", "leaf", "tie"], ["one"]).drop("one", "tie")
    ranked = cut(ranked.withColumnRenamed("before_one", "rank"))
    sources = ranked.groupBy("source").agg(F.min("rank").alias("first"), F.count("*").alias("n"))
    height = reduce(lambda h, k: F.when(F.col("n") > RUN**k, k + 1).otherwise(h), range(15), F.lit(0))
    sources = sources.withColumns({"height": height, "one": F.lit(1).cast("long")})
    sources = cut(with_running_sums(sources, ["source"], ["one"]).withColumnRenamed("before_one", "number"))
    n_sources, most = sources.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    top = _height(most) + 1  # the first level above all subroots

    number = F.col("number")
    above_subroot = _node(F.lit(0).cast("long"), number, top) if n_sources > 1 else F.lit(None).cast("long")

    def placed(level: DataFrame, height: int) -> DataFrame:
        """``level`` with the run of each node and its place there; subroots go on in the tree of sources."""
        done = F.col("height") == height
        up = F.when(done, above_subroot).otherwise(_node(F.col("first"), F.col("index"), height + 1))
        return level.withColumns(
            {"up": up, "place": _place(F.when(done, number).otherwise(F.col("index"))),
             "subroot": F.when(done, F.col("digest"))}
        )

    facts = sources.select(F.col("source").alias("name"), "first", "height", "number")
    rows = ranked.join(facts, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    bottom = rows.withColumns({"index": F.col("rank") - F.col("first"), "digest": F.col("leaf")})
    bottom = bottom.withColumns({"low": F.col("rank"), "high": F.col("rank")}).drop("rank")
    bottom = cut(placed(bottom, 0))
    bare = ["up", "place", "digest", "low", "high"]
    as_top = lambda level, k: level.where(F.col("height") == k).select(*bare, number.alias("index"))
    stored = ["id", F.col("up").alias("parent"), "place", "subroot", "run", "low", "high"]

    levels, level, subroots = [], bottom.drop("doc_id", "source", "leaf", "other"), as_top(bottom, 0)
    for k in range(1, top):
        nodes = cut(placed(_above(level.where(F.col("height") >= k).drop("subroot")), k))
        levels.append(nodes.select(*stored))
        subroots = subroots.unionByName(as_top(nodes, k))
        level = nodes.drop("id", "run")
    level = cut(subroots)
    for k in range(top, top + _height(n_sources)):
        last = k == top + _height(n_sources) - 1
        up = F.lit(None).cast("long") if last else _node(F.lit(0).cast("long"), F.col("index"), k + 1)
        nodes = _above(level).withColumns({"up": up, "place": _place(F.col("index")), "subroot": F.lit(None).cast("string")})
        nodes = cut(nodes)
        levels.append(nodes.select(*stored))
        level = nodes.drop("id", "run", "subroot")
    root = level.select("digest").first()
    return Tree(bottom, reduce(DataFrame.unionByName, levels) if levels else spark.createDataFrame([], _NODES), root and root[0])


# ---- proofs -----------------------------------------------------------------

_CLIMB = f"""
WITH RECURSIVE climb(chunk, doc_id, leaf, folded, up, place, subroot, path) AS (
  SELECT chunk, doc_id, leaf, other, up, place, subroot, CAST(array() AS ARRAY<STRUCT<node: BIGINT, place: INT>>) FROM {{leaves}}
  UNION ALL
  SELECT c.chunk, c.doc_id, c.leaf,
    sha2(concat(substring(n.run, 1, {_DIGEST} * c.place), c.folded, substring(n.run, {_DIGEST} * c.place + {_DIGEST + 1})), 256),
    n.parent, n.place, coalesce(c.subroot, n.subroot), concat(c.path, array(named_struct('node', c.up, 'place', c.place)))
  FROM climb c JOIN {{nodes}} n ON c.up = n.id AND c.chunk = n.chunk
)
SELECT chunk, doc_id, leaf, subroot, path, folded AS folded_root FROM climb WHERE up IS NULL
"""


@contextmanager
def _unbounded_recursion(spark: SparkSession) -> Iterator[None]:
    """Rows of a recursive query are as many as leaves times levels; the session's own limit is put back."""
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def climb(tree: Tree) -> DataFrame:
    """(chunk, doc_id, leaf, subroot, path, folded_root) per leaf, written; path has (node, place) from the leaf's run to the root's."""
    leaves = tree.leaves.withColumn("chunk", _chunk("low"))
    with _unbounded_recursion(leaves.sparkSession):
        return cut(leaves.sparkSession.sql(_CLIMB, leaves=leaves, nodes=_stored(tree)))


def _chunk(leaf: str) -> Column:
    return F.floor(F.col(leaf) / F.lit(CHUNK)).cast("long")


def _stored(tree: Tree) -> DataFrame:
    """Nodes, once for each chunk of leaves below."""
    return tree.nodes.withColumn("chunk", F.explode(F.sequence(_chunk("low"), _chunk("high")))).drop("low", "high")


def _beside(run: Column, place: Column) -> Column:
    """The digests of a run without the one at ``place``."""
    return F.concat(F.substring(run, F.lit(1), _DIGEST * place), F.substring(run, _DIGEST * place + _DIGEST + 1, F.lit(RUN * _DIGEST)))


def with_proofs(climbed: DataFrame, tree: Tree) -> DataFrame:
    """``climbed`` with ``proof``: the digests beside the path, from the leaf's run up, left to right."""
    nodes = _stored(tree).select(F.col("id").alias("node"), F.col("chunk").alias("in_chunk"), "run")
    at = lambda a, b: (F.col(a) == F.col("node")) & (F.col("chunk") == F.col("in_chunk"))
    first = climbed.withColumn("start", F.get("path", F.lit(0))["node"])
    # One path for each run (and chunk): the leaves of a run share all that is above it.
    paths = first.where("start is not null").groupBy("start", "chunk").agg(F.first("path").alias("path"))
    steps = paths.select("start", "chunk", F.posexplode("path").alias("step", "at")).select("start", "chunk", "step", "at.*")
    steps = steps.withColumnsRenamed({"node": "up", "place": "up_place"}).join(nodes, at("up", "node"))
    own = F.max(F.when(F.col("step") == 0, F.col("run")))
    above = F.collect_list(F.when(F.col("step") > 0, F.struct("step", _beside(F.col("run"), F.col("up_place")).alias("digests"))))
    texts = F.transform(F.array_sort(above), lambda x: x["digests"])
    runs = steps.groupBy(F.col("start").alias("of"), F.col("chunk").alias("of_chunk")).agg(own.alias("own"), F.array_join(texts, "").alias("above"))
    joined = first.join(runs, (F.col("start") == F.col("of")) & (F.col("chunk") == F.col("of_chunk")), "left")
    proof = F.concat(_beside(F.col("own"), F.get("path", F.lit(0))["place"]), F.col("above"))
    return joined.withColumn("proof", F.coalesce(proof, F.lit(""))).select(*climbed.columns, "proof")


def manifest(docs: DataFrame, tampered: Column | None = None, proofs: bool = False) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), one row per row of ``docs``.

    ``docs`` has ``FIELDS``; other columns are not read. ``tampered`` marks rows
    whose text is lower-cased (A-Z) before their digest climbs: they verify only
    if nothing changed. A null field is ``-`` in its leaf, a null source is a
    source of its own and comes first. Rows without id come first in their
    source; repeated rows are leaves of their own and lie side by side. A lone
    leaf is its source's subroot and a lone subroot the root; its proof is the
    hash of nothing. Empty in, empty out.
    """
    tree = build(leaves(docs, tampered))
    found = with_proofs(climb(tree), tree)
    root = F.lit(tree.root)
    return found.select(
        "doc_id", "leaf", "subroot", root.alias("root"), F.sha2("proof", 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == root).alias("verified"), *(["proof"] if proofs else []),
    )
