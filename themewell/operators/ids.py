"""Dense numbering and seeded sampling without a one-task sort of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from themewell.session import cut


def with_dense_rank(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """Number the rows 0..n-1 in the order of ``order_by`` (which must be unique).

    A range sort spreads the rows; each partition numbers its own rows and the
    partition sizes give the offsets. The sorted frame is written once, so the
    two reads see the same partitions. Only one row per partition is summed up.
    """
    placed = cut(df.orderBy(*order_by).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    within = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    return (
        placed.withColumn("_part", part)
        .join(offsets, "_part")
        .withColumn(name, F.col("_offset") + within)
        .drop("_at", "_part", "_offset")
    )


def _seeded(id_col: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), id_col.cast("string")))


def seeded_sample(df: DataFrame, n: int, seed: int = 42, id_col: str = "id") -> DataFrame:
    """The ``n`` rows whose seeded id digest is least; all rows if there are fewer.

    The digest's bit length puts each row in one of 60 classes, each about twice
    as large as the one below. Class sizes show which classes can hold one of
    the ``n`` least rows, so the final ordering sees about 2n rows rather than
    n rows from every partition. The class sizes are exact, and so is the sample.
    """
    digest = _seeded(F.col(id_col), seed)
    bits = F.length(F.bin(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")))
    below = Window.orderBy("_class").rowsBetween(Window.unboundedPreceding, -1)
    needed = (
        df.groupBy(bits.alias("_class"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_below", F.coalesce(F.sum("_rows").over(below), F.lit(0)))
        .where(F.col("_below") < n)
        .select("_class")
    )
    return (
        df.withColumn("_class", bits)
        .join(F.broadcast(needed), "_class", "left_semi")  # 60 rows at most
        .withColumn("_digest", digest)
        .orderBy("_digest", id_col)
        .limit(n)
        .drop("_class", "_digest")
    )
