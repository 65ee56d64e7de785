"""Agreement of clusters with held-out labels, and cluster counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themewell.functions.counts import n_log_n, pairs

# Fixed value: the cluster id of noise.
NOISE = -1


def without_noise(df: DataFrame, cluster_col: str = "cluster_id") -> DataFrame:
    return df.where(F.col(cluster_col) != NOISE)


def cluster_counts(assigned: DataFrame) -> DataFrame:
    """One row: clusters found, noise rows, and the noise share."""
    cluster = F.col("cluster_id")
    return assigned.agg(
        F.countDistinct(F.when(cluster != NOISE, cluster)).alias("n_clusters"),
        F.count_if(cluster == NOISE).alias("n_noise"),
        F.count(F.lit(1)).alias("n_total"),
    ).withColumn("noise_fraction", F.try_divide("n_noise", "n_total"))


def cluster_sizes(assigned: DataFrame) -> DataFrame:
    """Rows per cluster, noise left out."""
    return without_noise(assigned).groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))


def contingency(
    assigned: DataFrame, heldout: DataFrame, truth_col: str, exclude_noise: bool = True
) -> DataFrame:
    """``a`` (cluster), ``b`` (held-out label), ``n`` (rows of both)."""
    kept = without_noise(assigned) if exclude_noise else assigned
    return (
        kept.select("id", F.col("cluster_id").alias("a"))
        .join(heldout.select("id", F.col(truth_col).alias("b")).where("b is not null"), "id")
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def agreement(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``ari, nmi, n_evaluated`` from a contingency table, one row per ``by`` group.

    Adjusted Rand index (Hubert and Arabie 1985) and mutual information divided
    by the mean of the two entropies. Both need only sums over the cells and the
    two margins, so the three are stacked and summed at once. Without ``by`` an
    empty table gives one row of NaN.
    """
    by = list(by)

    def part(df: DataFrame, kind: str) -> DataFrame:
        return df.select(
            *by, F.lit(kind).alias("kind"), pairs(F.col("n")).alias("p"), n_log_n(F.col("n")).alias("l"), "n"
        )

    margin = lambda key: cells.groupBy(*by, key).agg(F.sum("n").alias("n"))
    stacked = part(cells, "ab").unionByName(part(margin("a"), "a")).unionByName(part(margin("b"), "b"))
    of = lambda kind, col: F.sum(F.when(F.col("kind") == kind, F.col(col)))
    sums = stacked.groupBy(*by).agg(
        *[of(k, "p").alias(f"p_{k}") for k in ("ab", "a", "b")],
        *[of(k, "l").alias(f"l_{k}") for k in ("ab", "a", "b")],
        *[F.count_if(F.col("kind") == k).alias(f"c_{k}") for k in ("ab", "a", "b")],
        F.coalesce(of("ab", "n"), F.lit(0)).alias("n"),
    )
    n = F.col("n").cast("double")
    by_chance = F.col("p_a") * F.col("p_b") / pairs(F.col("n"))
    ari = (F.col("p_ab") - by_chance) / ((F.col("p_a") + F.col("p_b")) / F.lit(2.0) - by_chance)
    shared = F.ln(n) + (F.col("l_ab") - F.col("l_a") - F.col("l_b")) / n
    entropies = F.lit(2.0) * F.ln(n) - (F.col("l_a") + F.col("l_b")) / n
    nmi = F.greatest(shared, F.lit(0.0)) / (entropies / F.lit(2.0))
    # Each cluster meets one label and the other way round: the same partition.
    same = (F.col("c_ab") == F.col("c_a")) & (F.col("c_ab") == F.col("c_b"))
    score = lambda value: (
        F.when(F.col("n") == 0, F.lit(float("nan"))).when(same, F.lit(1.0)).otherwise(value)
    )
    return sums.select(*by, score(ari).alias("ari"), score(nmi).alias("nmi"), F.col("n").alias("n_evaluated"))


def external_validation(
    assigned: DataFrame, heldout: DataFrame, truth_col: str, exclude_noise: bool = True
) -> DataFrame:
    """One row ``ari, nmi, n_evaluated, n_total``.

    ``n_total`` counts all assigned rows, noise and rows without a held-out
    label too; ``n_evaluated`` those that are scored.
    """
    cells = contingency(assigned, heldout, truth_col, exclude_noise)
    total = assigned.agg(F.count(F.lit(1)).alias("n_total"))
    return agreement(cells).withColumn("n_total", total.scalar())


def external_metrics(assigned: DataFrame, heldout: DataFrame, targets: Sequence[str]) -> DataFrame:
    """``method, metric, value`` for all methods, held-out columns and two scopes.

    ``assigned`` stacks ``id, method, cluster_id``. Scope ``own`` scores a method
    on the rows it does not call noise; ``shared`` scores all methods on the rows
    none of them calls noise, so that their numbers can be compared. ``coverage``
    is the share of rows a method scores. One pass over the joined rows.
    """
    is_noise = F.col("cluster_id") == NOISE
    shared = assigned.groupBy("id").agg((~F.bool_or(is_noise)).alias("shared"))
    labels = F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).cast("string").alias("b")) for t in targets])
    scopes = F.when(F.col("shared"), F.array(F.lit("own"), F.lit("shared"))).otherwise(F.array(F.lit("own")))
    rows = assigned.join(shared, "id").join(heldout.select("id", labels.alias("labels")), "id")
    cells = (
        rows.where(~is_noise)
        .select("method", F.col("cluster_id").alias("a"), "labels", F.explode(scopes).alias("scope"))
        .select("method", "a", "scope", F.inline("labels"))
        .groupBy("method", "scope", "target", "a", "b")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    scores = agreement(cells, ["method", "scope", "target"])
    name = lambda metric: F.concat_ws("_", F.lit(metric), F.lit("vs"), "target", "scope")
    one = lambda metric, value: F.struct(
        metric.alias("metric"), value.cast("double").alias("value")
    )
    agreed = scores.select(
        "method",
        F.inline(
            F.array(*[one(name(m), F.col(c)) for m, c in (("ari", "ari"), ("nmi", "nmi"), ("n", "n_evaluated"))])
        ),
    )
    covered = assigned.groupBy("method").agg(
        F.count_if(~is_noise).alias("n_scored"), F.count(F.lit(1)).alias("n_total")
    )
    coverage = covered.select("method", F.inline(F.array(one(F.lit("coverage"), F.col("n_scored") / F.col("n_total")))))
    return agreed.unionByName(coverage)
