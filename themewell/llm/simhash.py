"""Near-duplicate detection by SimHash and multi-index hashing.

A fingerprint is the bitwise majority over the hashes of a text's word
shingles. It is cut into segments. If two fingerprints differ in at most
``radius`` bits, one of ``m`` segments differs in at most ``radius // m`` bits,
so the small Hamming ball around each segment is enumerated, looked up in the
table of that segment, and the complete distance of what is found is checked.

Only one of two partners has to ask: where segments differ in one bit, the one
that has the bit unset asks for it set. Equal fingerprints are one node, so
copies cost nothing. Tables meet in Arrow batches sorted by segment; a meeting
emits a spanning forest of its links, never all pairs, and an entry with very
many fingerprints is cut into tiles that meet as tasks of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from themewell.llm.arrow import batch_of, map_batches, texts_of
from themewell.llm.components import components, merge
from themewell.session import cut

SEED = 42
MEMBERS = 4096  # fingerprints of one table entry that meet in one tile
_BLOCK = 1 << 16  # shingles whose bits are counted at a time


# ---- fingerprints -----------------------------------------------------------


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words of the text (of the whole, if it has fewer)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # on bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, "<u8")
    if len(words) <= width:
        runs = [b" ".join(words)]
    else:
        runs = list(map(b" ".join, zip(*(words[k:] for k in range(width)), strict=False)))
    return np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(SEED)), "<u8", len(runs))


def fingerprint(hashes: np.ndarray, n_words: int = 1) -> np.ndarray:
    """Bits set in over half the hashes; further words of 64 bits come from mixed hashes."""
    out = np.zeros(n_words, "<u8")
    if len(hashes):
        for k in range(n_words):
            ones = np.zeros(64, np.int64)
            for at in range(0, len(hashes), _BLOCK):
                block = _mixed(hashes[at : at + _BLOCK], k)
                bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                ones += _column_sums(bits)
            out[k] = np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0]
    return out


def _column_sums(bits: np.ndarray) -> np.ndarray:
    """Sums of 64 columns of zeros and ones: eight at a time as bytes of a word, up to 255 rows."""
    packed = np.ascontiguousarray(bits).view("<u8")
    total = np.zeros(64, np.int64)
    whole = len(packed) // 255 * 255
    for part in (packed[:whole].reshape(-1, 255, 8), packed[whole:][None]):
        if part.size:
            total += part.sum(axis=1, dtype=np.uint64).view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return total


def _mixed(hashes: np.ndarray, k: int) -> np.ndarray:
    if k == 0:
        return np.ascontiguousarray(hashes, "<u8")
    x = hashes + np.uint64(k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(docs: DataFrame, width: int = 3, n_words: int = 1) -> DataFrame:
    """(doc_id, fp): fp as big-endian bytes, 8 for each of ``n_words``; null or empty text: zeros."""

    def make(schema: pa.Schema):
        def run(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                fps = [
                    fingerprint(shingle_hashes(t.as_py(), width), n_words).astype(">u8").tobytes()
                    for t in batch.column("text")
                ]
                yield batch_of(schema, {"doc_id": batch.column("doc_id"), "fp": fps})

        return run

    return map_batches(texts_of(docs), make, "doc_id long, fp binary")


# ---- tables of segments -----------------------------------------------------


def _segment(bits: list[Column], at: int, size: int) -> Column:
    """Bits [at, at + size) of the 64-bit words, counted from the lowest bit of the first word."""
    word, low = divmod(at, 64)
    here = F.shiftrightunsigned(bits[word], low)
    if low + size > 64:
        here = here.bitwiseOR(F.shiftleft(bits[word + 1], 64 - low))
    return here.bitwiseAND(F.lit((1 << size) - 1))


def _words(n_words: int) -> list[Column]:
    return [F.conv(F.hex(F.substring("fp", 8 * k + 1, 8)), 16, -10).cast("long") for k in range(n_words)]


def _entries(nodes: DataFrame, n_words: int, segments: int, ball: int) -> DataFrame:
    """Rows (seg, key, asks, fp, id): each node stored once per segment, and its half balls asking."""
    size = 64 * n_words // segments
    if not 0 < size < 63:
        raise ValueError("a segment has 1 to 62 bits")
    bits = nodes.select("id", "fp", *[w.alias(f"w{k}") for k, w in enumerate(_words(n_words))])
    words = [F.col(f"w{k}") for k in range(n_words)]
    keys = F.array(*[F.struct(F.lit(s).alias("seg"), _segment(words, s * size, size).alias("key")) for s in range(segments)])
    rows = bits.select("id", "fp", F.explode(keys).alias("e")).select("id", "fp", "e.seg", "e.key")
    key = F.col("key")
    asked = key_ball(key, size, ball)
    out = rows.select("seg", "fp", "id", F.explode(asked).alias("x")).select(
        "seg", F.col("x.key").alias("key"), F.col("x.asks").alias("asks"), "fp", "id"
    )
    return out


def key_ball(key: Column, size: int, ball: int) -> Column:
    """Array of (key, asks): the key itself, and the keys within ``ball`` bits that are asked for.

    Of two keys that differ, the lesser in the highest bit they differ in has it
    unset; only this one asks, so each pair of keys is met once.
    """
    found = F.array(F.struct(key.alias("key"), F.lit(0).alias("asks")))
    if ball == 0:
        return found
    flips = [m for n in range(1, ball + 1) for m in _masks(size, n)]
    tops = [(m, 1 << (m.bit_length() - 1)) for m in flips]
    around = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(t).alias("t")) for m, t in tops])
    asking = F.filter(around, lambda x: key.bitwiseAND(x["t"]) == 0)
    return F.concat(found, F.transform(asking, lambda x: F.struct(key.bitwiseXOR(x["m"]).alias("key"), F.lit(1).alias("asks"))))


def _masks(size: int, n: int) -> list[int]:
    return [sum(1 << b for b in at) for at in combinations(range(size), n)]


def _tiled(entries: DataFrame, stored: DataFrame, size: int, ball: int, members: int) -> DataFrame:
    """Entries with ``tile`` and ``part``: an entry that may be large is cut into parts which meet two by two.

    Only entries with more than ``members`` stored rows, or within the ball of
    such a one, can exceed a fixed multiple of ``members``.
    """
    counts = stored.groupBy("seg", "key").agg(F.count("*").alias("n")).where(F.col("n") > members)
    wide = counts.select("seg", "n", F.explode(key_ball(F.col("key"), size, ball)).alias("x"))
    wide = wide.groupBy("seg", F.col("x.key").alias("key")).agg(F.sum("n").alias("n"))
    # Written first: most often it has few rows or none, and then the entries need not move for the join.
    wide = cut(wide.select("seg", "key", F.ceil(F.col("n") / F.lit(members)).cast("int").alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    rows = entries.join(wide, ["seg", "key"], "left").withColumn("parts", parts)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    meets = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda other: F.least(F.col("part"), other) * F.col("parts") + F.greatest(F.col("part"), other),
    )
    return rows.select("seg", "key", F.explode(meets).alias("tile"), "part", "asks", "fp", "id")


# ---- meetings ---------------------------------------------------------------


def _links_of(fps: np.ndarray, ids: np.ndarray, asks: np.ndarray, part: np.ndarray, radius: int) -> tuple[list, list]:
    """A spanning forest of the links of one tile; pairs of two that ask are not compared."""
    n, groups = len(ids), np.arange(len(ids))
    a, b = [], []
    cross = part.min() != part.max()
    for s in np.flatnonzero(asks == 0):
        near = np.bitwise_count(fps ^ fps[s]).sum(axis=1, dtype=np.int64) <= radius
        near &= (asks == 1) | (np.arange(n) > s)
        if cross:  # parts meet themselves in a tile of their own
            near &= part != part[s]
        near &= ids != ids[s]
        if near.any():
            found = merge(groups, s, np.flatnonzero(near))
            a += [int(ids[s])] * len(found)
            b += ids[found].tolist()
    return a, b


def _meet(rows: DataFrame, n_words: int, radius: int) -> DataFrame:
    """Links (a, b) found in tiles; rows come sorted by tile, so a task holds one batch and one tile."""

    def make(schema: pa.Schema):
        def ends(seg, key, tile) -> np.ndarray:
            return np.flatnonzero((seg[1:] != seg[:-1]) | (key[1:] != key[:-1]) | (tile[1:] != tile[:-1])) + 1

        def links(rows) -> tuple[list, list]:
            a, b = [], []
            seg, key, tile, part, asks, fps, ids = rows
            cuts = np.concatenate(([0], ends(seg, key, tile), [len(seg)]))
            sizes = np.diff(cuts)
            has = np.add.reduceat((asks == 0).astype(np.int64), cuts[:-1]) if len(seg) else sizes
            for g in np.flatnonzero((sizes > 1) & (has > 0)):
                at = slice(cuts[g], cuts[g + 1])
                x, y = _links_of(fps[at], ids[at], asks[at], part[at], radius)
                a += x
                b += y
            return a, b

        def run(batches: Iterator[pa.RecordBatch]):
            held = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                new = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("seg", "key", "tile", "part", "asks")]
                raw = batch.column("fp").cast(pa.binary(8 * n_words))
                flat = np.frombuffer(raw.buffers()[1], np.uint8)[8 * n_words * raw.offset :][: 8 * n_words * len(raw)]
                new += [flat.view("<u8").reshape(-1, n_words), batch.column("id").to_numpy(zero_copy_only=False)]
                rows = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
                last = ends(*rows[:3])
                last = last[-1] if len(last) else 0
                a, b = links([x[:last] for x in rows])
                held = [x[last:] for x in rows]
                yield batch_of(schema, {"a": a, "b": b})
            if held is not None:
                a, b = links(held)
                yield batch_of(schema, {"a": a, "b": b})

        return run

    dealt = rows.repartition("seg", "key", "tile").sortWithinPartitions("seg", "key", "tile", "asks")
    return map_batches(dealt, make, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    width: int = 3,
    radius: int = 3,
    n_words: int = 1,
    segments: int = 2,
    ball: int = 1,
    members: int = MEMBERS,
) -> DataFrame:
    """(doc_id, fp, component_id) for each row of ``docs``.

    Two rows are linked if their fingerprints differ in ``radius`` bits or less;
    ``component_id`` is the least doc_id that links lead to. With
    ``radius < segments * (ball + 1)`` every link is found. With a larger radius
    links beyond that bound are found if one segment is close enough.

    Null and empty texts have fingerprint zero and are linked like any other.
    Repeated ids keep a row each. A row whose id is null is linked by its
    fingerprint, but is never a component's name unless all of its component
    have no id. An empty table gives an empty one, other columns are ignored.
    """
    marks = cut(fingerprints(docs, width, n_words))
    # One node per fingerprint: its least id, or below all ids a number made from the fingerprint.
    made = -F.abs(F.xxhash64("fp") % F.lit(1 << 61)) - F.lit(1 << 62)
    nodes = marks.groupBy("fp").agg(F.min("doc_id").alias("first")).select("fp", F.coalesce("first", made).alias("id"))
    nodes = cut(nodes)
    size = 64 * n_words // segments
    # Nodes are narrow and lie in few files, but each asks for many keys: dealt out to as many tasks as a shuffle has.
    dealt = nodes.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id")
    entries = _entries(dealt, n_words, segments, ball)
    stored = _entries(nodes, n_words, segments, 0)
    links = _meet(_tiled(entries, stored, size, ball, members), n_words, radius)
    found = components(links)
    named = nodes.join(found, nodes["id"] == found["node"]).select("fp", F.col("component"), "id")
    # Numbers that were made up must not name a component that has a real id.
    real = F.when(F.col("id") > -(1 << 62), F.col("id"))
    names = named.groupBy("component").agg(F.min(real).alias("component_id"))
    linked = named.join(names, "component").select("fp", "component_id")
    alone = nodes.select("fp", F.when(F.col("id") > -(1 << 62), F.col("id")).alias("own"))
    whole = alone.join(linked.withColumnRenamed("fp", "linked_fp"), F.col("fp") == F.col("linked_fp"), "left")
    whole = cut(whole.select("fp", F.coalesce("component_id", "own").alias("component_id")))
    return marks.join(whole, "fp").select("doc_id", "fp", "component_id")
