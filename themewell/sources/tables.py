"""Reading input tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def write_whole(spark: SparkSession, path: str, text: str) -> None:
    """A small file that readers see as it was or as it is now, never in part: written aside, then renamed over."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    target, aside = hadoop.Path(path), hadoop.Path(f"{path}.{uuid.uuid4().hex}")
    out = aside.getFileSystem(conf).create(aside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    how = getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename")
    over = spark.sparkContext._gateway.new_array(how, 1)
    over[0] = how.OVERWRITE
    hadoop.FileContext.getFileContext(target.toUri(), conf).rename(aside, target, over)


def require_columns(df: DataFrame, columns: Sequence[str], what: str = "table") -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks column(s) {', '.join(missing)}; it has {', '.join(df.columns)}")
    return df


def read_table(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Read only ``columns`` of a Parquet table."""
    return require_columns(spark.read.parquet(path), columns, path).select(*columns)


def read_or_fetch(
    spark: SparkSession, cache_path: str, fetch: Callable[[SparkSession], DataFrame], force: bool = False
) -> DataFrame:
    """The raw table from its cache, or fetched, written and read back.

    ``force`` always fetches anew.
    """
    if force or not path_exists(spark, cache_path):
        fetch(spark).write.mode("overwrite").parquet(cache_path)
    return spark.read.parquet(cache_path)
