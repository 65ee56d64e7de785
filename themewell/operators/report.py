"""Report tables: key figures, cluster map, cluster catalogue, method comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themewell.functions import text as tx
from themewell.operators.agreement import cluster_counts, cluster_sizes
from themewell.session import cut

# Fixed values of the report.
SILHOUETTE_BANDS = (0.15, 0.5)
NMI_BANDS = (0.4, 0.7)
NOISE_PERCENT_FLAG = 15
CATALOGUE_EXAMPLES = 5

# Names are short, so this many are a few megabytes; more are left to adaptive execution.
BROADCAST_NAMES = 50_000


def cluster_catalogue(assigned: DataFrame, labels: DataFrame, example_rows: DataFrame) -> DataFrame:
    """``cluster_id, label, description, size, share, examples``; largest first.

    ``share`` is the percentage of all rows, noise included.
    """
    n_rows = assigned.agg(F.count(F.lit(1))).scalar()
    return (
        cluster_sizes(assigned)
        .join(labels.select("cluster_id", "label", "description"), "cluster_id", "left")
        .join(example_rows, "cluster_id", "left")
        .select(
            "cluster_id",
            F.coalesce("label", F.lit(tx.UNLABELED)).alias("label"),
            "description",
            "size",
            (F.lit(100.0) * F.col("size") / n_rows).alias("share"),
            F.slice("examples", 1, CATALOGUE_EXAMPLES).alias("examples"),
        )
        .orderBy(F.desc("size"), "cluster_id")
    )


def cluster_map(coords: DataFrame, assigned: DataFrame, texts: DataFrame, labels: DataFrame) -> DataFrame:
    """``id, x, y, cluster_id, is_noise, hover``: one row per point."""
    return (
        coords.select("id", "x", "y")
        .join(assigned.select("id", "cluster_id"), "id")
        .join(texts.select("id", "text"), "id")
        .join(_names(labels), "cluster_id", "left")
        .select(
            "id",
            "x",
            "y",
            "cluster_id",
            (F.col("cluster_id") == -1).alias("is_noise"),
            tx.hover(F.col("cluster_id"), F.col("label"), F.col("text")).alias("hover"),
        )
    )


def _names(labels: DataFrame) -> DataFrame:
    """Cluster names, broadcast while they are few; noise, which is many rows, must not meet them in one task."""
    names = cut(labels.select("cluster_id", "label"))
    return F.broadcast(names) if names.limit(BROADCAST_NAMES + 1).count() <= BROADCAST_NAMES else names


def map_bins(points: DataFrame, step: float) -> DataFrame:
    """Points per square of the map and cluster, so that a drawn map stays small."""
    return points.groupBy(
        F.floor(F.col("x") / step).alias("x_bin"), F.floor(F.col("y") / step).alias("y_bin"), "cluster_id"
    ).agg(F.count(F.lit(1)).alias("n"))


def kpi_report(assigned: DataFrame, silhouette: DataFrame, external: DataFrame) -> DataFrame:
    """``metric, value, band``: rows, clusters, noise, silhouette, agreement.

    ``silhouette`` and ``external`` are the one-row results of their operators.
    """
    facts = (
        cluster_counts(assigned)
        .withColumn("silhouette", silhouette.select("silhouette").scalar())
        .withColumn("nmi", external.select("nmi").scalar())
    )
    noise_percent = F.lit(100.0) * F.col("noise_fraction")
    row = lambda name, value, band: F.struct(
        F.lit(name).alias("metric"), value.cast("double").alias("value"), band.alias("band")
    )
    neutral = F.lit("neutral")
    return facts.select(
        F.inline(
            F.array(
                row("n_samples", F.col("n_total"), neutral),
                row("n_clusters", F.col("n_clusters"), neutral),
                row("n_noise", F.col("n_noise"), neutral),
                row("noise_percent", noise_percent, F.when(noise_percent > NOISE_PERCENT_FLAG, "warn").otherwise(neutral)),
                row("silhouette", F.col("silhouette"), tx.band(F.col("silhouette"), *SILHOUETTE_BANDS)),
                row("nmi", F.col("nmi"), tx.band(F.col("nmi"), *NMI_BANDS)),
            )
        )
    )


def method_comparison(metrics: DataFrame, first: str, second: str) -> DataFrame:
    """``metric, a, b``: two methods side by side from ``method, metric, value`` rows."""
    value_of = lambda m: F.max(F.when(F.col("method") == m, F.col("value")))
    return metrics.groupBy("metric").agg(value_of(first).alias("a"), value_of(second).alias("b"))
