"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source is a stream of words: its documents in a random order, and again in
another order if the target exceeds the source. A pass over the documents is cut
into blocks at fixed word positions, and a random permutation of a pass's blocks
says which of them are drawn: as many as the target holds, the last one in part.
A tree splits the exact block counts of all sources among the output shards: at
each node the left half's counts are one draw from the multivariate
hypergeometric distribution. Each shard takes its own turns of the permutation,
so blocks are disjoint, and orders what it got at random. A document at the edge
of a block is cut there.

The recipe (one row per source), words, positions and blocks are columns. The tree
first splits the block counts of groups of sources, on the driver, and then those
of each group's sources, in tasks: what a shard takes of a group is given there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themewell.llm.arrow import batch_of, map_batches
from themewell.llm.prefix import with_running_sums
from themewell.session import cut

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)  # by rank of the source, repeating
SHARE = 1.5  # words of the mix per word of all sources
MOST = 2  # times a document may be taken
GROUP = 4096  # sources whose blocks are split in one task
FEW_SOURCES = 20_000  # so many lines of the recipe are sent to all tasks, more are joined by shuffles
MAX_BLOCKS = 1 << 28  # blocks get longer beyond this many, as the draws count in these


def targets(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST) -> list[float]:
    """Words for each source: by weight, none above ``most`` times its size, the excess reshared by weight."""
    total = share * sum(sizes)
    limit = [most * s for s in sizes]
    full = [False] * len(sizes)
    while True:
        rest = total - sum(x for x, f in zip(limit, full, strict=True) if f)
        weight = sum(w for w, f in zip(weights, full, strict=True) if not f)
        out = [x if f else rest * w / weight for x, w, f in zip(limit, weights, full, strict=True)]
        over = [not f and t >= x for f, t, x in zip(full, out, limit, strict=True)]
        if not any(over):
            return out
        full = [f or o for f, o in zip(full, over, strict=True)]
        if all(full):
            return [float(x) for x in limit]


def split_quotas(blocks: list[int], shards: int, rng: np.random.Generator, quotas: list[int] | None = None) -> np.ndarray:
    """Counts (shard, source): columns summing to ``blocks``, rows to ``quotas``, or as equal as can be."""
    out = np.zeros((shards, len(blocks)), np.int64)

    def split(first: int, n: int, left: np.ndarray) -> None:
        if n == 1:
            out[first] = left
            return
        half = n // 2
        total = int(left.sum()) * half // n if quotas is None else sum(quotas[first : first + half])
        take = rng.multivariate_hypergeometric(left, total, method="marginals")
        split(first, half, take)
        split(first + half, n - half, left - take)

    if len(blocks):
        split(0, shards, np.asarray(blocks, np.int64))
    return out


def _with_targets(lines: DataFrame) -> DataFrame:
    """``lines`` (source_size, weight) with ``target``, as ``targets`` gives it.

    Among sources of one weight the smaller are full first, so what is full is
    told by the largest share offered to each weight; a round is one sum by weight.
    """
    total = None
    offered: dict[float, float] = {}
    while True:
        share = F.lit(-1.0)
        for w, x in offered.items():
            share = F.when(F.col("weight") == w, F.lit(x)).otherwise(share)
        full = F.col("source_size") * F.lit(MOST) <= share
        sums = lines.groupBy("weight", full.alias("full")).agg(F.count("*").alias("n"), F.sum("source_size").alias("size")).collect()
        total = SHARE * sum(r["size"] for r in sums) if total is None else total
        limit = F.col("source_size") * F.lit(float(MOST))
        open_weight = sum(r["weight"] * r["n"] for r in sums if not r["full"])
        if not open_weight:
            return lines.withColumn("target", limit)
        rest = total - sum(MOST * r["size"] for r in sums if r["full"])
        now = {r["weight"]: rest * r["weight"] / open_weight for r in sums}
        target = F.lit(rest) * F.col("weight") / F.lit(open_weight)
        if lines.where(~full & (target >= limit)).isEmpty():
            return lines.withColumn("target", F.when(full, limit).otherwise(target))
        offered = {w: max(x, offered.get(w, -1.0)) for w, x in now.items()}


def _with_bounds(lines: DataFrame, shards: int, seed: int) -> DataFrame:
    """``lines`` (rank, blocks) with bounds: ``bounds[j]`` blocks go to shards before j."""
    lines = lines.withColumn("group", F.floor(F.col("rank") / F.lit(GROUP)).cast("long"))
    # A row per group of GROUP sources.
    groups = sorted((r["group"], r["blocks"]) for r in lines.groupBy("group").agg(F.sum("blocks").alias("blocks")).collect())
    taken = split_quotas([n for _, n in groups], shards, np.random.default_rng([seed + 1, 1]))
    quotas = [(g, taken[:, i].tolist()) for i, (g, _) in enumerate(groups)]
    table = lines.sparkSession.createDataFrame(quotas, "group long, quotas array<long>")

    def make(schema: pa.Schema):
        def drawn(group: int, quotas: list[int], ranks: list[int], blocks: list[int]) -> pa.RecordBatch:
            rng = np.random.default_rng([seed, group])
            shares = split_quotas(blocks, shards, rng, quotas)
            bounds = np.concatenate((np.zeros((1, len(blocks)), np.int64), shares.cumsum(axis=0))).T.tolist()
            return batch_of(schema, {"line": ranks, "bounds": bounds})

        def run(batches: Iterator[pa.RecordBatch]):
            at, given, ranks, blocks = None, [], [], []
            for batch in batches:
                for row in batch.to_pylist():
                    if row["group"] != at:
                        if ranks:
                            yield drawn(at, given, ranks, blocks)
                        at, given, ranks, blocks = row["group"], row["quotas"], [], []
                    ranks.append(row["rank"])
                    blocks.append(row["blocks"])
            if ranks:
                yield drawn(at, given, ranks, blocks)

        return run

    dealt = lines.select("group", "rank", "blocks").join(table, "group").repartition("group").sortWithinPartitions("group", "rank")
    found = map_batches(dealt, make, "line long, bounds array<long>")
    return lines.drop("group").join(found, F.col("rank") == F.col("line")).drop("line")


def recipe(sized: DataFrame, shards: int, block_words: int, seed: int) -> tuple[DataFrame, int, int]:
    """The recipe of all sources, in order of code points, null last; the number of sources, and words of a block."""
    known = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    known = known.select(F.col("source").alias("name"), "source_size", F.isnull("source").alias("null"), F.lit(1).alias("one"))
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    ranked = with_running_sums(known, ["null", "name"], ["one"]).withColumnRenamed("before_one", "rank")
    ranked = cut(ranked.withColumn("weight", weights[F.col("rank") % F.lit(len(WEIGHTS))]).drop("null", "one"))
    n, words = ranked.agg(F.count("*"), F.coalesce(F.sum("source_size"), F.lit(0))).first()
    block_words = max(block_words, math.ceil(SHARE * words / MAX_BLOCKS))
    lines = _with_targets(ranked).withColumn("quota", F.rint("target").cast("long"))
    once = F.least("quota", "source_size")
    turns = [F.ceil(q / F.lit(block_words)).cast("long") for q in (once, F.col("quota") - once)]
    lines = lines.withColumns({"quotas": F.array(once, F.col("quota") - once), "turns": F.array(*turns), "blocks": turns[0] + turns[1]})
    lines = lines.withColumn("passes", F.when(F.col("quota") > F.col("source_size"), 2).otherwise(1))
    lines = lines.withColumn("span", F.col("passes") * F.col("source_size"))
    lines = with_running_sums(lines, ["rank"], ["span"]).withColumnRenamed("before_span", "base").drop("span", "weight")
    return cut(_with_bounds(lines, shards, seed)), n, block_words


def _drawn(lines: DataFrame, block_words: int, seed: int) -> DataFrame:
    """(line, in_pass, of_block, words, shard): the blocks that are drawn, how many of their words, and for which shard.

    The whole blocks of a pass are permuted by a hash, numbered in its order; the
    rest after the last whole block always has the last turn.
    """
    passes = lines.select("rank", "source_size", "bounds", F.posexplode("quotas").alias("pass", "words"), "turns")
    passes = passes.where("words > 0").withColumns(
        {"whole": F.floor(F.col("source_size") / F.lit(block_words)).cast("long"), "own": F.get("turns", F.col("pass")),
         "before": F.when(F.col("pass") == 0, F.lit(0)).otherwise(F.get("turns", F.lit(0)))}
    )
    passes = cut(passes.drop("turns"))
    blocks = passes.where("whole > 0").select("rank", "pass", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)).alias("block"))
    blocks = blocks.withColumns({"dice": F.xxhash64(F.lit(seed + 2), "rank", "pass", "block"), "one": F.lit(1).cast("long")})
    ordered = with_running_sums(blocks, ["rank", "pass", "dice", "block"], ["one"]).withColumnRenamed("before_one", "at")
    ordered = cut(ordered.select("rank", "pass", "block", "at"))
    first = ordered.groupBy("rank", "pass").agg(F.min("at").alias("first"))
    permuted = ordered.join(first, ["rank", "pass"]).select("rank", "pass", "block", (F.col("at") - F.col("first")).alias("turn"))
    permuted = passes.join(permuted, ["rank", "pass"]).where("turn < own")
    rest = passes.where("own > whole").withColumns({"block": F.col("whole"), "turn": F.col("whole")})
    turns = permuted.unionByName(rest)
    in_source = F.col("before") + F.col("turn")
    return turns.select(
        F.col("rank").alias("line"),
        F.col("pass").alias("in_pass"),
        F.col("block").alias("of_block"),
        F.least(F.lit(block_words), F.col("words") - F.col("turn") * F.lit(block_words)).alias("drawn_words"),
        (F.size(F.filter("bounds", lambda b: b <= in_source)) - 1).alias("shard"),
    )


def plan(
    docs: DataFrame, shards: int = 16, block_words: int = 8192, seed: int = 42, keys: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """What the mix takes: (documents, pieces).

    documents: doc_id, size, source_size, target, taken and ``keys``, a row per row of ``docs``.
    pieces: doc_id, source, pass, position (of the document in the pass), size,
    start (words of the document before the piece), taken, block, shard, place
    (order within the shard) and ``keys``, a row per document, pass and block of
    which words are taken.

    A null text has size 0, a null source is a source of its own. Repeated rows
    are documents of their own. No source, or no word at all: nothing is taken. A
    source takes its target, rounded to whole words. There may be any number of
    sources; blocks get longer where there would be more than ``MAX_BLOCKS``, as
    the draws end at 10^9.
    """
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        *[F.col(k) for k in keys],
        F.monotonically_increasing_id().alias("tie"),
    )
    sized = cut(sized)
    lines, n_sources, block_words = recipe(sized, shards, block_words, seed)
    facts = lines.select("name", "rank", "passes", "source_size", "target", "base")
    table = F.broadcast(facts) if n_sources <= FEW_SOURCES else facts
    joined = sized.join(table, F.col("source").eqNullSafe(F.col("name")))
    taken_in = F.explode(F.sequence(F.lit(0), F.col("passes") - 1)).alias("pass")
    narrow = joined.select("doc_id", "size", "rank", "name", "tie", F.col("base"), "source_size", taken_in, *keys)
    narrow = narrow.withColumn("dice", F.xxhash64(F.lit(seed), "pass", "doc_id", "size"))
    placed = with_running_sums(narrow, ["rank", "pass", "dice", "tie"], ["size"])
    position = F.col("before_size") - F.col("base") - F.col("pass") * F.col("source_size")
    placed = placed.where("size > 0").withColumn("position", position)
    block_of = lambda word: F.floor(word / F.lit(block_words)).cast("long")
    parts = F.sequence(block_of(F.col("position")), block_of(F.col("position") + F.col("size") - 1))
    parts = placed.withColumn("block", F.explode(parts))
    at = (F.col("rank") == F.col("line")) & (F.col("pass") == F.col("in_pass")) & (F.col("block") == F.col("of_block"))
    met = parts.join(_drawn(lines, block_words, seed), at)
    opens = F.col("block") * F.lit(block_words)
    start = F.greatest(F.lit(0), opens - F.col("position"))
    end = F.least(F.col("size"), opens + F.col("drawn_words") - F.col("position"))
    pieces = met.withColumns({"start": start, "taken": end - start}).where("taken > 0")
    place = F.xxhash64(F.lit(seed + 1), "block", "pass", "doc_id", "start")
    pieces = cut(pieces.withColumn("place", place).select(
        "doc_id", F.col("name").alias("source"), "pass", "position", "size", "start", "taken", "block", "shard", "place", "tie", *keys
    ))
    taken = pieces.groupBy(F.col("tie").alias("of")).agg(F.sum("taken").alias("taken"))
    documents = joined.join(taken, F.col("tie") == F.col("of"), "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), *keys
    )
    return documents, pieces.drop("tie")


def some_words(text, start, n):
    """Words ``start`` to ``start + n`` of a text, with the white space before each of them."""
    parts = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    return F.array_join(F.slice(parts, (start + 1).cast("int"), n.cast("int")), "")


def mix(docs: DataFrame, shards: int = 16, block_words: int = 8192, seed: int = 42) -> DataFrame:
    """The mixed documents with the columns of ``docs``, shard by shard, each in random order.

    A document taken twice is two rows, and so is one that lies in several blocks:
    each has the words of its block (``n_chars``, if there is such a column, then
    follows). Documents without words are not taken. Rows are told apart by doc_id
    and text, source and the columns that can be hashed; maps are left out there.
    """
    key = "_mix"
    while any(c.startswith(key) for c in docs.columns):
        key += "_"
    # Rows are named by all they hold; rows that hold the same are interchangeable, so one of them stands for all.
    own = [F.col(f.name) for f in docs.schema if "map" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    absent = [c.isNull() for c in own]
    names = {key + "1": F.xxhash64(F.lit(1), *own, *absent), key + "2": F.xxhash64(F.lit(2), *own, *absent)}
    named = docs.withColumns(names)
    _, pieces = plan(named, shards, block_words, seed, keys=tuple(names))
    wanted = pieces.select(*names, F.struct("size", "start", "taken", "shard", "place", "pass").alias(key + "p"))
    joined = named.dropDuplicates(list(names)).join(wanted, list(names))
    part = F.col(key + "p")
    short = part["taken"] < part["size"]
    changed = {"text": F.when(short, some_words(F.col("text"), part["start"], part["taken"])).otherwise(F.col("text"))}
    mixed = joined.withColumns(changed)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        mixed = mixed.withColumn("n_chars", F.when(short, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    mixed = mixed.withColumns({key + "s": part["shard"], key + "o": part["place"], key + "q": part["pass"], key + "b": part["start"]})
    order = [key + "s", key + "o", *names, key + "q", key + "b"]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order).select(*docs.columns)
