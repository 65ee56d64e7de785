"""Contiguous shards of equal bytes, cut from global prefix sums. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themewell.llm.arrow import texts_of
from themewell.llm.prefix import with_running_sums
from themewell.session import cut

ROW_BYTES = 8


def assign(docs: DataFrame, shards: int = 24) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per row of ``docs``.

    Documents in ascending doc_id order are cut at equal targets of bytes: a
    document belongs to the shard in which its middle byte falls, so a shard
    misses its target by half a document at each end at most. ``slot`` counts
    the documents of a shard from 0. ``law`` is ``bytes``; ``grown_shard`` is null,
    as a cut by bytes has no rule for one more shard.

    A null text has no bytes and no checksum, an empty one has checksum 0.
    Null ids come first; repeated ids lie side by side, in order of size, checksum
    and place in the input. Equal texts are not kept together: one group may be
    larger than a shard. Empty in, empty out; other columns are not read.
    """
    texts = texts_of(docs)
    narrow = texts.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.lit(1).cast("long").alias("one"),
        F.monotonically_increasing_id().alias("place"),
    )
    # The texts are read once, here; all that follows is narrow.
    narrow = cut(narrow)
    total = narrow.agg(F.sum("size")).head()[0] or 1
    rows = with_running_sums(narrow, ["doc_id", "size", "text_crc32", "place"], ["size", "one"])
    # Twice the middle, in whole numbers; decimal, as bytes times shards may pass 64 bits.
    twice = (2 * F.col("before_size") + F.col("size")).cast("decimal(30,0)")
    shard = F.least(F.floor(twice * shards / F.lit(2 * total).cast("decimal(30,0)")).cast("int"), F.lit(shards - 1))
    rows = cut(rows.withColumn("shard", shard))
    first = rows.groupBy("shard").agg(F.min("before_one").alias("first"))
    return rows.join(F.broadcast(first), "shard").select(  # one row per shard
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("before_one") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write(docs: DataFrame, path: str, shards: int = 24) -> None:
    """The rows of ``docs`` with all their columns in folders ``shard=<n>``, each in doc_id order.

    Ids have to be unique here, as they bring shard and row together.
    """
    dealt = assign(docs, shards).select(F.col("doc_id").alias("_id"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    joined = docs.join(dealt, F.col("doc_id").eqNullSafe(F.col("_id"))).drop("_id")
    ordered = joined.repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot")
    ordered.withColumnRenamed("_shard", "shard").drop("_slot").write.partitionBy("shard").parquet(path)
