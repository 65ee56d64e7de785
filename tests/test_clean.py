import pytest
from pyspark.sql import functions as F

from themewell.functions import text as tx
from themewell.operators import clean, ids
from themewell.sources.tables import require_columns

RAW = [
    (0, "  please stop my parcel  ", "order", "cancel"),
    (1, "please stop my parcel", "order2", "cancel2"),
    (2, "", "x", "x"),
    (3, "where is my invoice?", "bill", "find"),
    (4, "talk to a human", "contact", "agent"),
    (5, None, "x", "x"),
    (6, "Talk to a human", "contact", "agent"),
]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(RAW, "id long, text string, category string, intent string").repartition(3)


def test_clean_strips_drops_and_keeps_the_first(raw):
    kept = clean.dedupe_first(clean.clean_text(raw))
    rows = kept.orderBy("id").collect()
    assert [(r.id, r.text, r.category) for r in rows] == [
        (0, "please stop my parcel", "order"),
        (3, "where is my invoice?", "bill"),
        (4, "talk to a human", "contact"),
        (6, "Talk to a human", "contact"),
    ]
    numbered = ids.with_dense_rank(kept.select("id"), ["id"], "n").orderBy("id").collect()
    assert [r.n for r in numbered] == [0, 1, 2, 3]


def test_cleaning_twice_changes_nothing(raw):
    once = clean.dedupe_first(clean.clean_text(raw))
    twice = clean.dedupe_first(clean.clean_text(once))
    assert sorted(once.collect()) == sorted(twice.collect())


def test_labels_stay_apart(raw):
    split = clean.split_heldout(clean.clean_text(raw))
    assert split.texts.columns == ["id", "text"]
    assert split.labels.columns == ["id", "category", "intent"]


def test_every_white_space_is_stripped_at_the_ends_only(spark):
    python = {chr(i) for i in range(0x110000) if chr(i).isspace()}
    assert set(tx.WHITESPACE) == python and len(tx.WHITESPACE) == 29
    rows = [(i, f"{c}a{c}{c}b{c}") for i, c in enumerate(tx.WHITESPACE)]
    df = spark.createDataFrame(rows, "id long, text string")
    assert all(r.text == f"a{tx.WHITESPACE[r.id] * 2}b" for r in clean.clean_text(df).collect())
    assert {r.text for r in clean.clean_text(df, collapse_inner=True).collect()} == {"a b"}


def test_conflicting_labels_are_counted(raw):
    row = clean.label_conflicts(clean.clean_text(raw), ["category", "intent"]).first()
    assert (row.n_texts, row.n_conflicting) == (4, 1)


def test_profile(raw):
    heldout = clean.split_heldout(clean.clean_text(raw)).labels
    row = clean.label_profile(heldout).first()
    assert row.n_category == 4 and row.n_intent == 4
    assert row.categories == ["bill", "contact", "order", "order2"]


@pytest.mark.parametrize("n", [0, 1, 7, 100, 500, 900])
def test_sample_is_the_least_digests(spark, n):
    import hashlib

    df = spark.range(500).repartition(7)
    got = {r.id for r in ids.seeded_sample(df, n, seed=7).collect()}
    order = sorted(range(500), key=lambda i: hashlib.md5(f"7:{i}".encode()).hexdigest())
    assert got == set(order[:n])


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="intent"):
        require_columns(spark.range(1), ["id", "intent"])


def test_bands_and_hover(spark):
    rows = [(0.5,), (0.2,), (0.1,), (float("nan"),)]
    df = spark.createDataFrame(rows, "v double").select(tx.band(F.col("v"), 0.15, 0.5).alias("b"))
    assert [r.b for r in df.collect()] == ["good", "mid", "warn", "undefined"]
    long = spark.createDataFrame([(-1, None, "x" * 81), (2, "name", "y" * 80)], "c int, l string, t string")
    got = [r.h for r in long.select(tx.hover(F.col("c"), F.col("l"), F.col("t")).alias("h")).collect()]
    assert got == ["cluster -1: noise<br>" + "x" * 80 + "...", "cluster 2: name<br>" + "y" * 80]
