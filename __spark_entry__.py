"""Registered queries, the flagship query, and their SQL counterparts."""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracle  # noqa: E402
from themewell.operators import (  # noqa: E402
    agreement,
    clean,
    density,
    embed,
    ids,
    kmeans,
    labels,
    layout,
    neighbors,
    project,
    reach_tree,
    report,
    represent,
    silhouette,
    sweep,
)
from themewell.session import cut  # noqa: E402
from themewell.sources.tables import read_table  # noqa: E402

try:
    from themewell.llm import queries as llm
except ModuleNotFoundError as missing:  # the subpackage and its pipeline can be left out
    if missing.name not in ("themewell.llm", "corpus_pipeline"):
        raise
    llm = None

NEIGHBORS = 5


# ---- inputs -----------------------------------------------------------------


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    return read_table(spark, f"{sf_dir}/documents.parquet", columns).withColumnRenamed("doc_id", "id")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean texts, first of each copy, with category = lang and intent = source."""
    kept = clean.dedupe_first(clean.clean_text(_raw(spark, sf_dir)))
    return kept.withColumnsRenamed({"lang": "category", "source": "intent"})


def _stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, written once for the queries that read texts several times."""
    return cut(_docs(spark, sf_dir))


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is known of the clean texts, without the texts, written once."""
    return cut(_docs(spark, sf_dir).select("id", "category", "intent", "n_chars"))


def _tasks(docs: DataFrame) -> int:
    """Texts may come in one file: the dear work on them is dealt out over as many tasks as a shuffle has."""
    return int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _doc_vectors(docs: DataFrame) -> DataFrame:
    """Hashed vectors, written once for the operators that read them many times."""
    return cut(embed.embed_hash(docs, tasks=_tasks(docs)))


def _terms(assigned: DataFrame, docs: DataFrame) -> DataFrame:
    return labels.keyword_terms(assigned, docs, tasks=_tasks(docs))


def _by_language(docs: DataFrame) -> DataFrame:
    """A fixed assignment for exact checks: one cluster per language, short texts are noise."""
    numbered = ids.with_dense_rank(docs.select("category").distinct(), ["category"], "number")
    cluster = F.when(F.col("n_chars") < 300, agreement.NOISE).otherwise(F.col("number"))
    return docs.join(numbered, "category").select(
        "id", F.lit("by_language").alias("method"), cluster.cast("int").alias("cluster_id")
    )


def _by_length(docs: DataFrame) -> DataFrame:
    """A second fixed assignment: three classes of text length."""
    cluster = F.when(F.col("n_chars") < 1000, 0).when(F.col("n_chars") < 3000, 1).otherwise(2)
    return docs.select("id", F.lit("by_length").alias("method"), cluster.cast("int").alias("cluster_id"))


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/embeddings.parquet", ["vec_id", "embedding", "label"]).withColumnRenamed(
        "vec_id", "id"
    )


def _by_label(vectors: DataFrame) -> DataFrame:
    """A fixed assignment of the vectors: their label, the last of them as noise."""
    cluster = F.when(F.col("label") == 9, agreement.NOISE).otherwise(F.col("label"))
    return vectors.select("id", cluster.cast("int").alias("cluster_id"))


def _r6(name: str):
    return F.round(name, 6).alias(name)


# ---- cleaning and embedding -------------------------------------------------


def clean_text(spark, sf_dir):
    return clean.clean_text(_raw(spark, sf_dir)).select(F.col("id").alias("doc_id"), "text")


def dedupe_first(spark, sf_dir):
    kept = clean.dedupe_first(clean.clean_text(_raw(spark, sf_dir)))
    return kept.select(F.col("id").alias("doc_id"), "text", "lang", "source")


def label_conflicts(spark, sf_dir):
    return clean.label_conflicts(clean.clean_text(_raw(spark, sf_dir)), ["lang", "source"])


def dense_id(spark, sf_dir):
    kept = _docs(spark, sf_dir).select(F.col("id").alias("doc_id"))
    return ids.with_dense_rank(kept, ["doc_id"], "id")


def heldout_split(spark, sf_dir):
    return clean.split_heldout(_docs(spark, sf_dir)).labels.withColumnRenamed("id", "doc_id")


def heldout_texts(spark, sf_dir):
    return clean.split_heldout(_docs(spark, sf_dir)).texts.withColumnRenamed("id", "doc_id")


def seeded_sample(spark, sf_dir):
    rows = _raw(spark, sf_dir).select("id")
    return ids.seeded_sample(rows, 200, seed=42).select(F.col("id").alias("doc_id"))


def label_profile(spark, sf_dir):
    heldout = clean.split_heldout(_docs(spark, sf_dir)).labels
    return clean.label_profile(heldout).withColumn("categories", F.array_join("categories", ","))


def embed_hash(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    rows = embed.sparse_rows(embed.embed_hash(docs, tasks=_tasks(docs)))
    value = F.round(F.col("value").cast("double"), 6)
    return rows.select(F.col("id").alias("doc_id"), "bucket", value.alias("value"))


# ---- counts and agreement ---------------------------------------------------


def cluster_counts(spark, sf_dir):
    counts = agreement.cluster_counts(_by_language(_docs(spark, sf_dir)))
    return counts.select("n_clusters", "n_noise", "n_total", _r6("noise_fraction"))


def cluster_sizes(spark, sf_dir):
    return agreement.cluster_sizes(_by_language(_docs(spark, sf_dir)))


def contingency(spark, sf_dir):
    docs = _facts(spark, sf_dir)
    return agreement.contingency(_by_language(docs), docs, "intent")


def external_ari(spark, sf_dir):
    docs = _facts(spark, sf_dir)
    scores = agreement.external_validation(_by_language(docs), docs, "intent")
    return scores.select(_r6("ari"), "n_evaluated", "n_total")


def external_nmi(spark, sf_dir):
    docs = _facts(spark, sf_dir)
    scores = agreement.external_validation(_by_length(docs), docs, "category")
    return scores.select(_r6("nmi"), "n_evaluated", "n_total")


def external_partial(spark, sf_dir):
    """Agreement with quality labels that only some of the texts have."""
    docs = _facts(spark, sf_dir)
    partial = read_table(spark, f"{sf_dir}/labels.parquet", ["doc_id", "quality"]).withColumnRenamed("doc_id", "id")
    scores = agreement.external_validation(_by_language(docs), partial, "quality")
    return scores.select(_r6("ari"), _r6("nmi"), "n_evaluated", "n_total")


def method_comparison(spark, sf_dir):
    docs = _facts(spark, sf_dir)
    stacked = _by_language(docs).unionByName(_by_length(docs))
    metrics = agreement.external_metrics(stacked, docs, ["category", "intent"])
    table = report.method_comparison(metrics, "by_language", "by_length")
    return table.select("metric", _r6("a"), _r6("b"))


# ---- vectors ----------------------------------------------------------------


def centroids(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    means = represent.centroids(vectors, _by_label(vectors))
    return means.select("cluster_id", F.posexplode("centroid").alias("dim", "mean")).select(
        "cluster_id", "dim", _r6("mean")
    )


def representatives(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    nearest = represent.nearest_to_centroid(vectors, _by_label(vectors))
    return nearest.select("cluster_id", "rank", F.col("id").alias("vec_id"), _r6("dist"))


def silhouette_sampled(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    scores = silhouette.silhouette(vectors, _by_label(vectors), sample_size=200)
    return scores.select(_r6("silhouette"), "n_scored")


def silhouette_linear(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    return silhouette.silhouette_linear(vectors, _by_label(vectors)).select(_r6("silhouette"), "n_scored")


def silhouette_exact(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    scores = silhouette.silhouette(vectors, _by_label(vectors), sample_size=None)
    return scores.select(_r6("silhouette"), "n_scored")


def pairwise_knn(spark, sf_dir):
    hood = neighbors.neighborhood(_vectors(spark, sf_dir), NEIGHBORS)
    rows = neighbors.row_neighbors(hood, NEIGHBORS)
    return rows.select(F.col("id").alias("vec_id"), "rank", "other", _r6("dist"))


def core_distance(spark, sf_dir):
    hood = neighbors.neighborhood(_vectors(spark, sf_dir), NEIGHBORS)
    return neighbors.row_core_distances(hood, NEIGHBORS).select(F.col("id").alias("vec_id"), _r6("core"))


def mutual_reachability(spark, sf_dir):
    hood = neighbors.neighborhood(_vectors(spark, sf_dir), NEIGHBORS)
    pairs = neighbors.mutual_reachability(
        neighbors.row_neighbors(hood, NEIGHBORS), neighbors.row_core_distances(hood, NEIGHBORS)
    )
    return pairs.select(F.col("id").alias("vec_id"), "rank", "other", _r6("mrd"))


def hdbscan_mst(spark, sf_dir):
    hood = neighbors.neighborhood(_vectors(spark, sf_dir), NEIGHBORS)
    tree = reach_tree.reachability_tree(hood, cut(neighbors.core_distances(hood, NEIGHBORS)))
    first = hood.points.select("vid", "first_id")
    name = lambda end: first.select(F.col("vid").alias(end), F.col("first_id").alias(f"{end}_id"))
    named = tree.join(name("a"), "a").join(name("b"), "b")
    return named.select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), _r6("w"))


# ---- clustering of documents ------------------------------------------------


def kmeans_assign(spark, sf_dir):
    return kmeans.run_kmeans(_doc_vectors(_docs(spark, sf_dir)), k=4).assigned


def k_search(spark, sf_dir):
    scores, _, _ = kmeans.search_k(_doc_vectors(_docs(spark, sf_dir)))
    return scores.select("k", _r6("silhouette"), "n_scored")


def k_search_short(spark, sf_dir):
    """Three values of k, with the passes that each took."""
    scores, _, _ = kmeans.search_k(_doc_vectors(_docs(spark, sf_dir)), (4, 8, 12))
    return scores.select("k", _r6("silhouette"), "n_scored", "steps", "converged")


def hdbscan_labels(spark, sf_dir):
    return density.run_hdbscan(_doc_vectors(_docs(spark, sf_dir)))


def hdbscan_sweep(spark, sf_dir):
    docs = _stage(spark, sf_dir)
    results = sweep.sweep(_doc_vectors(docs), docs, "category").results.drop("elapsed_s")
    # An unset min_samples is shown as an empty cell, as in the CSV of the sweep.
    shown = F.coalesce(F.col("min_samples").cast("string"), F.lit(""))
    scores = {c: F.round(c, 6) for c in ("noise_fraction", "silhouette", "ari", "nmi")}
    return results.withColumns({**scores, "min_samples": shown})


def project_2d(spark, sf_dir):
    coords = project.project_2d(_doc_vectors(_docs(spark, sf_dir)))
    # Plus 0, so that a small negative value is 0 and not -0.
    r4 = lambda name: (F.round(name, 4) + F.lit(0.0)).alias(name)
    return coords.select("id", r4("x"), r4("y"), "method")


def spectral_map(spark, sf_dir):
    coords = layout.spectral_map(_doc_vectors(_docs(spark, sf_dir))).coords
    r4 = lambda name: (F.round(name, 4) + F.lit(0.0)).alias(name)
    return coords.select("id", r4("x"), r4("y"), "method")


# ---- labelling and reporting ------------------------------------------------


def keyword_labels(spark, sf_dir):
    docs = _stage(spark, sf_dir)
    return _terms(_by_language(docs), docs)


def label_requests(spark, sf_dir):
    docs = _stage(spark, sf_dir)
    assigned = _by_language(docs)
    nearest = represent.nearest_to_centroid(_doc_vectors(docs), assigned)
    requests = labels.label_requests(assigned, represent.examples(nearest, docs))
    return requests.select("cluster_id", "size", "prompt")


def cluster_catalogue(spark, sf_dir):
    docs = _stage(spark, sf_dir)
    assigned = _by_language(docs)
    nearest = represent.nearest_to_centroid(_doc_vectors(docs), assigned)
    names = labels.keyword_labels(_terms(assigned, docs))
    table = report.cluster_catalogue(assigned, names, represent.examples(nearest, docs))
    joined = F.array_join("examples", " || ").alias("examples")
    return table.select("cluster_id", "label", "description", "size", _r6("share"), joined)


def _coords(docs: DataFrame) -> DataFrame:
    return docs.select("id", F.col("n_chars").cast("double").alias("x"), F.col("id").cast("double").alias("y"))


def cluster_map(spark, sf_dir):
    docs = _stage(spark, sf_dir)
    assigned = _by_language(docs)
    names = labels.keyword_labels(_terms(assigned, docs))
    return report.cluster_map(_coords(docs), assigned, docs, names).withColumnRenamed("id", "doc_id")


def cluster_map_bins(spark, sf_dir):
    docs = _facts(spark, sf_dir)
    return report.map_bins(_coords(docs).join(_by_language(docs), "id"), 250.0)


def kpi_report(spark, sf_dir):
    docs = _stage(spark, sf_dir)
    assigned, vectors = cut(_by_language(docs)), _doc_vectors(docs)
    external = agreement.external_validation(assigned, docs, "intent")
    facts = report.kpi_report(assigned, silhouette.silhouette_linear(vectors, assigned), external)
    return facts.select("metric", _r6("value"), "band")


# ---- contract ---------------------------------------------------------------


def discover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean, embed, cluster with K-Means, and describe each cluster."""
    docs = _stage(spark, sf_dir)
    vectors = _doc_vectors(docs)
    assigned = cut(kmeans.run_kmeans(vectors, k=4).assigned)
    nearest = represent.nearest_to_centroid(vectors, assigned)
    names = labels.keyword_labels(_terms(assigned, docs))
    table = report.cluster_catalogue(assigned, names, represent.examples(nearest, docs))
    joined = F.array_join("examples", " || ").alias("examples")
    return table.select("cluster_id", "label", "description", "size", _r6("share"), joined)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: from raw texts to a catalogue of named clusters."""
    return discover(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {
        "clean_text": clean_text,
        "dedupe_first": dedupe_first,
        "label_conflicts": label_conflicts,
        "dense_id": dense_id,
        "heldout_split": heldout_split,
        "heldout_texts": heldout_texts,
        "seeded_sample": seeded_sample,
        "label_profile": label_profile,
        "embed_hash": embed_hash,
        "cluster_counts": cluster_counts,
        "cluster_sizes": cluster_sizes,
        "contingency": contingency,
        "external_ari": external_ari,
        "external_nmi": external_nmi,
        "external_partial": external_partial,
        "method_comparison": method_comparison,
        "centroids": centroids,
        "representatives": representatives,
        "silhouette_sampled": silhouette_sampled,
        "silhouette_exact": silhouette_exact,
        "silhouette_linear": silhouette_linear,
        "pairwise_knn": pairwise_knn,
        "core_distance": core_distance,
        "mutual_reachability": mutual_reachability,
        "hdbscan_mst": hdbscan_mst,
        "kmeans_assign": kmeans_assign,
        "k_search": k_search,
        "k_search_short": k_search_short,
        "hdbscan_labels": hdbscan_labels,
        "hdbscan_sweep": hdbscan_sweep,
        "project_2d": project_2d,
        "spectral_map": spectral_map,
        "keyword_labels": keyword_labels,
        "label_requests": label_requests,
        "cluster_catalogue": cluster_catalogue,
        "cluster_map": cluster_map,
        "cluster_map_bins": cluster_map_bins,
        "kpi_report": kpi_report,
        "discover": discover,
    }
    return own | (llm.queries() if llm else {})


def oracle_sql() -> dict[str, str]:
    return oracle.statements() | (llm.oracle_sql() if llm else {})
