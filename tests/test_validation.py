import math

import brute
import numpy as np
import pytest
from conftest import clumps

from themewell.operators import agreement, silhouette


@pytest.fixture
def score(spark, assigned_of):
    """Scores of clusters against labels; a label of None means that the row has none."""

    def run(clusters, truth, **options):
        rows = [(i, t) for i, t in enumerate(truth) if t is not None]
        heldout = spark.createDataFrame(rows, "id long, truth string")
        return agreement.external_validation(assigned_of(clusters), heldout, "truth", **options).first()

    return run


def information(table):
    """Mutual information over the mean entropy, cell by cell."""
    p = np.array(table, float) / np.sum(table)
    rows, columns = p.sum(1), p.sum(0)
    shared = sum(v * math.log(v / (rows[i] * columns[j])) for (i, j), v in np.ndenumerate(p) if v)
    entropy = lambda q: -sum(v * math.log(v) for v in q if v)
    return shared / ((entropy(rows) + entropy(columns)) / 2)


def spell(table):
    """Clusters and labels of a contingency table."""
    cells = [(a, "pqrs"[b]) for (a, b), n in np.ndenumerate(np.array(table)) for _ in range(n)]
    return [a for a, _ in cells], [b for _, b in cells]


def test_hand_computed_table(score):
    # 4 + 1 over 0 + 3: pairs 6 + 3 = 9 together, 10 + 3 = 13 by cluster, 6 + 6 = 12 by label, 28 in all.
    table = [[4, 1], [0, 3]]
    row = score(*spell(table))
    chance = 13 * 12 / 28
    assert row.ari == pytest.approx((9 - chance) / (12.5 - chance), abs=1e-12)
    # The sums written out: cells 1/2, 1/8, 3/8; margins 5/8, 3/8 and 1/2, 1/2.
    shared = 0.5 * math.log(0.5 / (5 / 16)) + 0.125 * math.log(0.125 / (5 / 16)) + 0.375 * math.log(0.375 / (3 / 16))
    mean = (-(5 / 8) * math.log(5 / 8) - (3 / 8) * math.log(3 / 8) + math.log(2)) / 2
    assert row.nmi == pytest.approx(shared / mean, abs=1e-12)
    assert (row.n_evaluated, row.n_total) == (8, 8)


@pytest.mark.parametrize("table", [[[5, 0, 2], [1, 7, 0]], [[1, 1], [1, 1]], [[3, 0], [0, 2], [4, 4]], [[2, 3, 4, 5]]])
def test_information_cell_by_cell(score, table):
    if len(table) > 1:
        assert score(*spell(table)).nmi == pytest.approx(information(table), abs=1e-12)
    else:
        assert score(*spell(table)).nmi == 0.0


def test_renamed_partition_is_one(score):
    row = score([7, 3, 3, 9, 9, 9, 7], list("zuuiiiz"))
    assert (row.ari, row.nmi) == (1.0, 1.0)


def test_noise_is_counted_and_not_scored(score):
    clusters, truth = [4, 4, -1, 2, 2, -1, -1], list("ggghhhg")
    row = score(clusters, truth)
    assert (row.ari, row.nmi, row.n_evaluated, row.n_total) == (1.0, 1.0, 4, 7)
    everything = score(clusters, truth, exclude_noise=False)
    assert everything.n_evaluated == 7 and everything.ari < 1.0


def test_rows_without_label_count_in_the_total_only(score):
    row = score([0, 0, 1, 1, -1, 0], ["a", "a", "b", None, None, None])
    assert (row.ari, row.n_evaluated, row.n_total) == (1.0, 3, 6)
    none = score([0, 1, -1], [None] * 3)
    assert math.isnan(none.ari) and math.isnan(none.nmi) and (none.n_evaluated, none.n_total) == (0, 3)


def test_one_sided_single_class(score):
    row = score([6, 6, 6, 6, 6], list("kmkmk"))
    assert (row.ari, row.nmi) == (0.0, 0.0)


@pytest.mark.parametrize("seed", [5, 6])
def test_agreement_against_pair_counting(score, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 6, 75), rng.integers(0, 3, 75)
    together = [[(u[i] == u[j]) for i in range(75) for j in range(i)] for u in (a, b)]
    both = sum(x and y for x, y in zip(*together))
    in_a, in_b, all_pairs = sum(together[0]), sum(together[1]), 75 * 74 // 2
    chance = in_a * in_b / all_pairs
    row = score(a, [str(v) for v in b])
    assert row.ari == pytest.approx((both - chance) / ((in_a + in_b) / 2 - chance), abs=1e-12)


def test_metrics_on_own_and_shared_rows(spark):
    rows = [(i, "m1", c) for i, c in enumerate([0, 0, 1, -1])] + [(i, "m2", c) for i, c in enumerate([0, 0, 1, 1])]
    assigned = spark.createDataFrame(rows, "id long, method string, cluster_id int")
    heldout = spark.createDataFrame([(i, t) for i, t in enumerate("aabc")], "id long, truth string")
    got = {(r.method, r.metric): r.value for r in agreement.external_metrics(assigned, heldout, ["truth"]).collect()}
    assert got["m1", "coverage"] == 0.75 and got["m2", "coverage"] == 1.0
    assert got["m2", "n_vs_truth_own"] == 4 and got["m2", "n_vs_truth_shared"] == 3
    assert got["m1", "ari_vs_truth_own"] == 1.0 and got["m2", "ari_vs_truth_shared"] == 1.0
    assert got["m2", "ari_vs_truth_own"] < 1.0


def test_silhouettes_equal_plain_pairs(vectors_of, assigned_of):
    x = clumps((14, 9, 11), noise=6.0)
    labels = np.repeat([4, 0, 2], [14, 9, 11])
    labels[::5] = -1
    kept = labels != -1
    pairs = silhouette.silhouette(vectors_of(x), assigned_of(labels), None).first()
    assert pairs.silhouette == pytest.approx(brute.silhouette(x[kept], labels[kept]), abs=1e-9)
    linear = silhouette.silhouette_linear(vectors_of(x), assigned_of(labels)).first()
    assert linear.silhouette == pytest.approx(brute.squared_silhouette(x[kept], labels[kept]), abs=1e-9)
    assert pairs.n_scored == linear.n_scored == kept.sum()


def test_a_sample_scores_just_these_rows(vectors_of, assigned_of):
    x, labels = clumps((40, 30), noise=3.0), np.repeat([0, 1], [40, 30])
    row = silhouette.silhouette(vectors_of(x), assigned_of(labels), 25).first()
    taken = sorted(sorted(range(70), key=lambda i: brute.digest(42, i))[:25])
    assert row.n_scored == 25
    assert row.silhouette == pytest.approx(brute.silhouette(x[taken], labels[taken]), abs=1e-9)


@pytest.mark.parametrize("clusters", [[3] * 6, [-1] * 6, [2, -1, -1, -1, -1, -1]])
def test_fewer_than_two_clusters_are_undefined(vectors_of, assigned_of, clusters):
    x = clumps((4, 2))
    assert math.isnan(silhouette.silhouette(vectors_of(x), assigned_of(clusters), None).first().silhouette)
    assert math.isnan(silhouette.silhouette_linear(vectors_of(x), assigned_of(clusters)).first().silhouette)


def test_tiles_and_portions_do_not_change_the_silhouette(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(90, 3)))
    labels = rng.integers(0, 5, size=(90, 2))
    labels[0] = [7, 7]
    rows = [(i, [float(v) for v in x[i]], [int(c) for c in labels[i]]) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, embedding array<double>, labels array<int>")
    for tile in (1000, 17):
        got = {r.labelling: r.silhouette for r in silhouette.silhouette_scores(df, 2, tile).collect()}
        for which in (0, 1):
            assert got[which] == pytest.approx(brute.silhouette(x, labels[:, which]), abs=1e-9)
    for limit in (1 << 20, 50):
        monkeypatch.setattr(silhouette, "SUMS_BYTES", limit)
        got = {r.labelling: r.silhouette for r in silhouette.linear_scores(df, 2).collect()}
        for which in (0, 1):
            assert got[which] == pytest.approx(brute.squared_silhouette(x, labels[:, which]), abs=1e-9)
