"""Running sums in a global order, from totals per partition. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from themewell.session import cut

PART = "_part"


def with_running_sums(rows: DataFrame, order: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """``rows`` with ``before_<c>`` for each c in ``sums``: its sum over all rows before, in the order given.

    ``order`` has to tell all rows apart. Rows are dealt out by range once and
    written, as ranges are drawn from a sample; then each partition's total
    (one row each) gives where it starts.
    """
    dealt = cut(rows.repartitionByRange(*order).withColumn(PART, F.spark_partition_id()))
    totals = dealt.groupBy(PART).agg(*[F.sum(c).alias(f"all_{c}") for c in sums])
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(PART, *[F.coalesce(F.sum(f"all_{c}").over(earlier), F.lit(0)).alias(f"start_{c}") for c in sums])
    inside = Window.partitionBy(PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumns({f"before_{c}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in sums})
    # One row per partition: as many as the dealing made, whatever the data.
    joined = local.join(F.broadcast(starts), PART)
    moved = joined.withColumns({f"before_{c}": F.col(f"before_{c}") + F.col(f"start_{c}") for c in sums})
    return moved.drop(PART, *[f"start_{c}" for c in sums])
