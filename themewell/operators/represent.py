"""Centroids and the texts nearest to them."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from themewell.functions.vectors import l2_distance
from themewell.operators.agreement import without_noise
from themewell.session import cut

# Fixed value: how many example texts stand for a cluster.
DEFAULT_EXAMPLES = 8

# Distances that agree to this many places are ties, so sums taken in another
# order do not change the rank.
TIE_PLACES = 9

BROADCAST_BYTES = 64 << 20
SALTS = 32


def centroids(vectors: DataFrame, assigned: DataFrame) -> DataFrame:
    """``cluster_id, centroid``: the component-wise mean, noise left out.

    Means are combined inside each task first, so a large cluster moves one
    partial sum per task.
    """
    return (
        vectors.join(without_noise(assigned).select("id", "cluster_id"), "id")
        .groupBy("cluster_id")
        .agg(Summarizer.mean(array_to_vector("embedding")).alias("centroid"))
        .withColumn("centroid", vector_to_array("centroid"))
    )


def _with_centroid(members: DataFrame, means: DataFrame) -> DataFrame:
    """Members next to their centroid, without bringing a cluster to one task.

    Centroids that are measured to be small are broadcast. Otherwise clusters
    are spread over salts and each centroid is repeated once per salt.
    """
    n_clusters, width = means.agg(F.count(F.lit(1)), F.max(F.size("centroid"))).first()
    if n_clusters * 8 * (width or 0) <= BROADCAST_BYTES:
        return members.join(F.broadcast(means), "cluster_id")
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")
    repeated = means.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return members.withColumn("salt", salt).join(repeated, ["cluster_id", "salt"])


def nearest_to_centroid(
    vectors: DataFrame, assigned: DataFrame, n_examples: int = DEFAULT_EXAMPLES
) -> DataFrame:
    """``cluster_id, rank, id, dist``: the rows nearest to each centroid.

    Ties (to nine places) go to the smaller id. The rank filter keeps
    ``n_examples`` rows per cluster in each task before the shuffle, and only
    ids and distances are ranked.
    """
    members = vectors.join(without_noise(assigned).select("id", "cluster_id"), "id")
    near = _with_centroid(members, cut(centroids(vectors, assigned))).select(
        "cluster_id", "id", l2_distance(F.col("embedding"), F.col("centroid")).alias("dist")
    )
    order = Window.partitionBy("cluster_id").orderBy(F.round("dist", TIE_PLACES), "id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n_examples)


def examples(nearest: DataFrame, texts: DataFrame, distinct: bool = False) -> DataFrame:
    """``cluster_id, examples``: example texts in rank order.

    ``distinct`` keeps the first of texts that differ in case only.
    """
    ranked = nearest.select("cluster_id", "rank", "id").join(texts.select("id", "text"), "id")
    if distinct:
        ranked = ranked.groupBy("cluster_id", F.lower("text").alias("_low")).agg(
            F.min("rank").alias("rank"), F.min_by("text", "rank").alias("text")
        )
    in_order = F.array_sort(F.collect_list(F.struct("rank", "text")))
    return ranked.groupBy("cluster_id").agg(in_order.getField("text").alias("examples"))
