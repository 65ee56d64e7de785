import json

import pytest

from themewell.operators.sweep import Setting
from themewell.plans import pipeline
from themewell.sources.stages import StageStore, StaleStage
from themewell.sources.tables import read_or_fetch


@pytest.fixture
def store(spark, tmp_path):
    return StageStore(spark, str(tmp_path / "stages"), "r1")


def test_whole_run(spark, store, tmp_path):
    topics = {"refund": "i want a refund for order", "login": "cannot log in to my account", "ship": "where is parcel"}
    rows = [
        (i, f"{text} {word}", topic, f"{topic}_{i % 2}")
        for i, (topic, text, word) in enumerate(
            (t, s, w) for t, s in topics.items() for w in "now today please again soon asap fast quick help thanks".split()
        )
    ]
    raw = spark.createDataFrame(rows + [(99, rows[0][1], "other", "other")], "id long, text string, category string, intent string")
    with pytest.raises(FileNotFoundError, match="not there"):
        store.read("texts")
    pipeline.load(store, lambda: raw)
    assert store.read("texts").count() == 30 and "category" not in store.read("texts").columns
    pipeline.embed(store)
    pipeline.discover(store, k=3, min_cluster_size=5, min_samples=2)
    metrics = {(r.method, r.metric): r.value for r in pipeline.validate(store).collect()}
    assert metrics["kmeans", "ari_vs_category_own"] == 1.0
    assert metrics["hdbscan", "n_clusters"] == 3
    pipeline.write_summary(store, str(tmp_path / "summary"))
    summary = json.loads(spark.read.text(str(tmp_path / "summary"), wholetext=True).first().value)
    assert (summary["n_samples"], summary["embedding_dim"]) == (30, 384)
    assert summary["kmeans"]["external_validation"]["category"]["own"] == {"ari": 1.0, "nmi": 1.0, "n": 30.0}
    assert (summary["kmeans"]["k"], summary["kmeans"]["k_search"]) == (3, [])
    assert (summary["hdbscan"]["min_cluster_size"], summary["hdbscan"]["min_samples"]) == (5, 2)
    assert summary["hdbscan"]["n_clusters"] == 3 and -1 <= summary["kmeans"]["silhouette"] <= 1
    assert store.missing() == ["coords", "catalogue"]
    with pytest.raises(FileNotFoundError, match="coords, catalogue"):
        pipeline.make_report(store)
    pipeline.place(store)

    def flaky():
        def label(prompt):
            if "refund" in prompt:
                raise ConnectionError("down")
            return json.dumps({"label": "x", "description": "y"})

        return label

    progress = []
    pipeline.label(store, flaky, clusters_at_once=2, retry_delay=0, on_labelled=lambda c: progress.append(c.count()))
    assert progress[-1] == 2 and len(progress) == 2
    pipeline.label(store)
    assert store.read("catalogue").count() == 3
    tables = pipeline.make_report(store)
    assert tables["map"].count() == 30
    assert tables["catalogue"].count() == 3
    assert {r.metric for r in tables["kpi"].collect()} >= {"n_samples", "silhouette", "nmi"}
    assert tables["comparison"].where("metric = 'coverage'").count() == 1
    settings = [Setting("a", 5, 2), Setting("b", 8, None)]
    csv = str(tmp_path / "sweep")
    pipeline.tune(store, csv, settings)
    back = spark.read.csv(csv, header=True)
    assert {r.name: r.min_samples for r in back.collect()} == {"a": "2", "b": None}


def test_force_makes_a_stage_anew(store, spark):
    store.once("texts", lambda: spark.createDataFrame([(1, "a")], "id long, text string"))
    again = store.once("texts", lambda: spark.createDataFrame([(2, "b")], "id long, text string"))
    assert again.first().id == 1
    forced = store.once("texts", lambda: spark.createDataFrame([(2, "b")], "id long, text string"), force=True)
    assert forced.first().id == 2


def test_raw_cache(spark, tmp_path):
    calls = []

    def fetch(session):
        calls.append(1)
        return session.range(3)

    path = str(tmp_path / "raw")
    for force in (False, False, True):
        assert read_or_fetch(spark, path, fetch, force).count() == 3
    assert len(calls) == 2


RAW = "id long, text string, category string, intent string"


def raw_of(spark, n):
    return lambda: spark.createDataFrame([(i, f"text {i} about {'tea' if i % 2 else 'rain'}", "c", "i") for i in range(n)], RAW)


def test_a_sample_and_all_texts_are_not_mixed_up(store, spark):
    raw = raw_of(spark, 50)
    for size, n in ((10, 10), (None, 50), (10, 10), (20, 20)):
        pipeline.load(store, raw, sample_size=size)
        assert store.read("texts").count() == store.read("labels").count() == n


def test_another_model_encodes_anew_and_what_follows_is_stale(store, spark):
    from themewell.operators import embed

    pipeline.load(store, raw_of(spark, 50))
    pipeline.embed(store)
    pipeline.place(store)
    assert len(store.read("vectors").first().embedding) == 384
    small = lambda df: embed.embed_hash(df, dim=3)
    pipeline.embed(store, small, model="small")
    assert len(store.read("vectors").first().embedding) == 3 and store.read("vectors").count() == 50
    with pytest.raises(StaleStage, match="older vectors"):
        store.read("coords")
    before = store.stamp("vectors")
    pipeline.embed(store, small, model="small")
    assert store.stamp("vectors") == before


def test_two_runs_share_a_store_of_vectors(spark, tmp_path):
    for run in ("r1", "r2"):
        store = StageStore(spark, str(tmp_path / "stages"), run)
        pipeline.load(store, raw_of(spark, 50))
        pipeline.embed(store)
        assert store.read("vectors").count() == 50


def test_names_belong_to_one_method_and_clustering(store, spark):
    pipeline.load(store, raw_of(spark, 20))
    pipeline.embed(store)
    named = lambda: (lambda prompt: json.dumps({"label": "x", "description": "y"}))

    def assigned(clusters):
        rows = [(i, m, c) for m, cs in clusters.items() for i, c in enumerate(cs)]
        store.write("assigned", spark.createDataFrame(rows, "id long, method string, cluster_id int"), inputs=["vectors"])

    assigned({"hdbscan": [0] * 20, "kmeans": [0] * 12 + [1] * 8})
    assert [r["size"] for r in pipeline.label(store, named).collect()] == [20]
    assert sorted(r["size"] for r in pipeline.label(store, named, method="kmeans").collect()) == [8, 12]
    assigned({"hdbscan": [0] * 5 + [-1] * 15, "kmeans": [0] * 20})
    assert [r["size"] for r in pipeline.label(store, named).collect()] == [5]
    assert [r["size"] for r in pipeline.label(store, named, method="kmeans").collect()] == [20]


def test_files_that_lack_a_column_count_as_missing(store, spark):
    spark.createDataFrame([(1, 2.0)], "id long, x double").write.parquet(store.path("coords"))
    assert "coords" in store.missing(["coords"])
    store.write("coords", spark.createDataFrame([(1, 2.0, 3.0, "pca")], "id long, x double, y double, method string"))
    assert store.missing(["coords"]) == []


def test_a_write_that_breaks_off_leaves_the_former_stage(store, spark):
    from pyspark.sql import functions as F

    two = "id long, text string"
    store.write("texts", spark.createDataFrame([(1, "a")], two), settings={"n": 1})
    before, stamp = store.read("texts"), store.stamp("texts")
    for mode in ("overwrite", "append"):
        broken = spark.range(100, numPartitions=4).select("id", F.expr("if(id = 99, raise_error('lost'), 'x')").alias("text"))
        with pytest.raises(Exception, match="lost"):
            store.write("texts", broken, mode=mode, settings={"n": 2})
        assert store.stamp("texts") == stamp and store.about("texts")["settings"] == {"n": 1}
        assert [r.text for r in store.read("texts").collect()] == ["a"] and store.missing(["texts"]) == []
    store.write("texts", spark.createDataFrame([(2, "b")], two), mode="append")
    assert sorted(r.id for r in store.read("texts").collect()) == [1, 2]
    # A stage can be made from itself, and a reader of the table before keeps it.
    store.write("texts", store.read("texts").where("id = 2"))
    assert [r.id for r in store.read("texts").collect()] == [2] and before.count() == 1
    store.write("texts", store.read("texts"))
    files = spark._jvm.java.io.File(store.path("texts")).list()
    assert sum(f.startswith("part-") for f in files) == 2


def test_nothing_is_left_of_intermediates(spark, store, tmp_path):
    from themewell.session import cut, ensure_checkpoint_dir, intermediates

    ensure_checkpoint_dir(spark)
    folder = spark._jvm.java.io.File(spark._jvm.java.net.URI(spark.sparkContext.getCheckpointDir()).getPath())
    before = set(folder.list() or [])
    pipeline.load(store, raw_of(spark, 40))
    pipeline.embed(store)
    pipeline.discover(store, k=2, min_cluster_size=5, min_samples=2)
    pipeline.validate(store)
    pipeline.place(store)
    with pytest.raises(ZeroDivisionError), intermediates(spark):
        cut(spark.range(3))
        1 / 0
    assert set(folder.list() or []) == before
    assert store.read("assigned").count() == 80 and store.read("metrics").count() > 4
