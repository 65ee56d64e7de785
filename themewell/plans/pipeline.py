"""The steps of a run, each reading and writing stage tables."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from functools import reduce, wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themewell.operators import agreement, density, kmeans, labels, layout, project, report, represent, silhouette, sweep
from themewell.operators.clean import clean_text, dedupe_first, split_heldout
from themewell.operators.embed import HASH_MODEL, embed_cached, embed_hash
from themewell.operators.ids import seeded_sample
from themewell.session import intermediates
from themewell.sources.stages import REPORT_STAGES, StageStore, write_csv

TARGETS = ("category", "intent")


def _step(make):
    """A step whose results are all stored when it ends: what it wrote on the way is deleted then."""

    @wraps(make)
    def run(store: StageStore, *args, **options):
        with intermediates(store.spark):
            return make(store, *args, **options)

    return run


@_step
def load(
    store: StageStore, read_raw: Callable[[], DataFrame], sample_size: int | None = None, seed: int = 42, force: bool = False
) -> None:
    """Raw rows to clean ``texts`` and held-out ``labels``. A sample keeps its ids."""
    raw = store.once("raw", read_raw, force)

    def clean() -> DataFrame:
        kept = dedupe_first(clean_text(raw))
        return kept if sample_size is None else seeded_sample(kept, sample_size, seed)

    chosen = {"sample_size": sample_size, "seed": seed if sample_size is not None else None}
    texts = store.once("texts", lambda: split_heldout(clean()).texts, force, chosen, ["raw"])
    heldout = lambda: split_heldout(raw.join(texts.select("id"), "id", "left_semi")).labels
    store.once("labels", heldout, force, inputs=["raw", "texts"])


@_step
def embed(
    store: StageStore, encode: Callable[[DataFrame], DataFrame] = embed_hash, model: str = HASH_MODEL, force: bool = False
) -> None:
    """Vectors for the texts; texts that any run has encoded before are looked up."""
    cache = f"{store.root}/embedding_store"
    store.once("vectors", lambda: embed_cached(store.read("texts"), cache, encode, model), force, {"model": model}, ["texts"])


@_step
def discover(
    store: StageStore,
    k: int | None = None,
    k_range: Sequence[int] = kmeans.DEFAULT_K_RANGE,
    min_cluster_size: int = density.DEFAULT_MIN_CLUSTER_SIZE,
    min_samples: int | None = density.DEFAULT_MIN_SAMPLES,
) -> None:
    """Both clusterings of the vectors."""
    vectors = store.read("vectors")
    flat = kmeans.run_kmeans(vectors, k, k_range)
    if flat.scores is not None:
        store.write("k_search", flat.scores, inputs=["vectors"])
    dense = density.run_hdbscan(vectors, min_cluster_size, min_samples)
    chosen = {"k": flat.k, "k_search": flat.scores is not None, "min_cluster_size": min_cluster_size, "min_samples": min_samples}
    store.write("assigned", flat.assigned.unionByName(dense), settings=chosen, inputs=["vectors"])


def _of(assigned: DataFrame, method: str) -> DataFrame:
    return assigned.where(F.col("method") == method)


@_step
def validate(store: StageStore, methods: Sequence[str] = ("kmeans", "hdbscan")) -> DataFrame:
    """``method, metric, value``: counts, silhouette, and agreement with the held-out labels."""
    vectors, assigned = store.read("vectors"), store.read("assigned")
    frames = [agreement.external_metrics(assigned, store.read("labels"), TARGETS)]
    for method in methods:
        rows = _of(assigned, method)
        inside = silhouette.silhouette_linear(vectors, rows)
        counts = agreement.cluster_counts(rows)
        for facts in (inside, counts):
            entries = [
                F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in facts.columns
            ]
            frames.append(facts.select(F.lit(method).alias("method"), F.inline(F.array(*entries))))
    return store.write("metrics", reduce(DataFrame.unionByName, frames), inputs=["vectors", "assigned", "labels"])


def run_summary(store: StageStore) -> dict:
    """What a run found, as a nested dictionary: sizes, settings, the search for k, and each method's measures.

    There are some twenty measures per method and a line per k, so this is small
    whatever the tables hold.
    """
    vectors, settings = store.read("vectors"), store.about("assigned").get("settings", {})
    width = vectors.select(F.size("embedding").alias("n")).limit(1).collect()
    out: dict = {"n_samples": vectors.count(), "embedding_dim": width[0]["n"] if width else 0}
    # A search counts only if the clusters came from it.
    searched = settings.get("k_search") and store.has("k_search")
    curve = store.read("k_search").orderBy("k").collect() if searched else []
    for r in store.read("metrics").collect():
        method = out.setdefault(r["method"], {})
        if "_vs_" in r["metric"]:
            measure, rest = r["metric"].split("_vs_", 1)
            target, scope = rest.rsplit("_", 1)
            method.setdefault("external_validation", {}).setdefault(target, {}).setdefault(scope, {})[measure] = r["value"]
        else:
            method[r["metric"]] = r["value"]
    out.setdefault("kmeans", {}).update(
        k=settings.get("k"), k_search=[{"k": r["k"], "silhouette": r["silhouette"], "n_scored": r["n_scored"]} for r in curve]
    )
    out.setdefault("hdbscan", {}).update({s: settings.get(s) for s in ("min_cluster_size", "min_samples")})
    return out


def write_summary(store: StageStore, path: str) -> None:
    """The summary as one JSON text under ``path``; undefined measures are null."""
    plain = lambda v: {k: plain(x) for k, x in v.items()} if isinstance(v, dict) else None if v != v else v
    row = store.spark.createDataFrame([(json.dumps(plain(run_summary(store)), sort_keys=True),)], "value string")
    row.coalesce(1).write.mode("overwrite").text(path)


@_step
def tune(store: StageStore, csv_path: str, settings: Sequence[sweep.Setting] = sweep.DEFAULT_SETTINGS) -> DataFrame:
    """The settings sweep, ranked by inside measures and written as CSV."""
    results = sweep.rank_settings(sweep.sweep(store.read("vectors"), store.read("labels"), "category", settings).results)
    write_csv(results.coalesce(1), csv_path)  # one row per setting
    return store.spark.createDataFrame(results.collect(), results.schema)


@_step
def place(store: StageStore, n_neighbors: int | None = None) -> DataFrame:
    """Coordinates by principal components, or with ``n_neighbors`` by the layout that keeps so many neighbours together."""
    vectors = store.read("vectors")
    if n_neighbors is None:
        return store.write("coords", project.project_2d(vectors), inputs=["vectors"])
    found = layout.spectral_map(vectors, n_neighbors)
    facts = {"n_neighbors": n_neighbors, "passes": found.passes, "converged": found.converged}
    return store.write("coords", found.coords, settings=facts, inputs=["vectors"])


@_step
def label(
    store: StageStore,
    make_labeler: Callable[[], Callable[[str], str]] | None = None,
    method: str = "hdbscan",
    clusters_at_once: int = 64,
    strict: bool = False,
    on_labelled: Callable[[DataFrame], None] | None = None,
    **labeler_options,
) -> DataFrame:
    """The catalogue, filled ``clusters_at_once`` at a time.

    Each portion is appended when it is done, so a broken run goes on with the
    clusters that have no name yet. Rows carry the method and the stamp of the
    clustering they describe; those of other clusterings are not taken for these. Without a labeler, names are key words.
    Failed clusters stay out of the table and are asked again by the next run;
    ``strict`` raises for them instead.
    """
    texts, vectors = store.read("texts"), store.read("vectors")
    assigned = _of(store.read("assigned"), method).drop("method")
    nearest = represent.nearest_to_centroid(vectors, assigned)
    requests = labels.label_requests(assigned, represent.examples(nearest, texts))
    made_from = store.stamp("assigned")
    if store.has("catalogue"):
        requests = requests.join(catalogue(store, method).select("cluster_id"), "cluster_id", "left_anti")
    requests = requests.persist()
    try:
        if make_labeler is None:
            names = labels.keyword_labels(labels.keyword_terms(assigned, texts))
            portions = [(requests, names)]
        else:
            # Portions are numbered by the range of ids they hold; ids are dense.
            last = requests.agg(F.max("cluster_id")).first()[0]
            starts = range(0, (last if last is not None else -1) + 1, clusters_at_once)
            portions = [(requests.where(F.col("cluster_id").between(s, s + clusters_at_once - 1)), None) for s in starts]
        for asked, names in portions:
            if names is None:
                names = labels.apply_labeler(asked, make_labeler, **labeler_options).persist()
                if strict:
                    labels.require_labels(names)
                names = names.where(F.col("status") == "done")
            done = asked.join(names, "cluster_id").select(
                "cluster_id", "label", "description", "size", "examples",
                F.lit(method).alias("method"), F.lit(made_from).alias("made_from"),
            )
            store.write("catalogue", done, mode="append")
            if on_labelled is not None:
                on_labelled(catalogue(store, method))
    finally:
        requests.unpersist()
    return catalogue(store, method)


def catalogue(store: StageStore, method: str) -> DataFrame:
    """The named clusters of a method's present clustering."""
    of_these = (F.col("method") == method) & F.col("made_from").eqNullSafe(F.lit(store.stamp("assigned")))
    return store.read("catalogue").where(of_these)


def make_report(store: StageStore, method: str = "hdbscan", other: str = "kmeans") -> dict[str, DataFrame]:
    """Key figures, map, catalogue and comparison; an error names what is missing."""
    missing = store.missing(REPORT_STAGES)
    if missing:
        raise FileNotFoundError(f"run {store.run_id} lacks: {', '.join(missing)}")
    assigned, metrics = _of(store.read("assigned"), method), store.read("metrics")
    named = catalogue(store, method)
    value = lambda name: F.max(F.when((F.col("method") == method) & (F.col("metric") == name), F.col("value")))
    figures = metrics.agg(value("silhouette").alias("silhouette"), value("nmi_vs_category_own").alias("nmi"))
    return {
        "kpi": report.kpi_report(assigned, figures, figures),
        "map": report.cluster_map(store.read("coords"), assigned, store.read("texts"), named),
        "catalogue": report.cluster_catalogue(assigned, named, named.select("cluster_id", "examples")),
        "comparison": report.method_comparison(metrics, method, other),
    }
