"""Small helpers around Arrow batches and frames, shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def arrow_schema(spec: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spec)


def batch_of(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    """A batch with the columns in the order and the types of ``schema``."""
    return pa.RecordBatch.from_arrays([_array(columns[f.name], f.type) for f in schema], schema=schema)


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


#: Rows of a batch where the session leaves Spark's own number: texts are long, and a batch is held several times.
BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Sets the session's rows per Arrow batch to ``BATCH_ROWS``, unless they were chosen."""
    if spark.conf.get(_BATCH_SETTING) == "10000":
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))


def map_batches(df: DataFrame, make: Callable[[pa.Schema], Callable], schema: str) -> DataFrame:
    """``mapInArrow`` where ``make(schema)`` gives a function from batches to batches."""
    bound_batches(df.sparkSession)
    spec = StructType.fromDDL(schema)
    wanted = arrow_schema(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return make(wanted)(batches)

    return df.mapInArrow(run, spec)


def partition_id() -> int:
    """Number of the running task's partition (0 outside of a task, as in tests)."""
    context = TaskContext.get()
    return context.partitionId() if context else 0


def texts_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) and nothing else, so that other columns can neither clash nor be read."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
