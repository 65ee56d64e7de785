import numpy as np
import pytest

from samples import SF

from themewell.llm import metric_join


def plain(rows, least):
    """{vec_id: (links, component)} by all pairs; rows of (vec_id, vector, label) with usable vectors."""
    out, by = {}, {}
    for i, v, label in rows:
        out[i] = (0, i)
        by.setdefault((label, len(v)), []).append((i, v))
    for (label, _), part in by.items():
        x = np.array([v for _, v in part], float)
        x /= np.linalg.norm(x, axis=1)[:, None]
        near = x @ x.T >= least
        np.fill_diagonal(near, False)
        ids = np.array([i for i, _ in part])
        at = ids.copy()
        while True:
            new = np.minimum(at, np.where(near, at[None], 1 << 60).min(1))
            if (new == at).all():
                break
            at = new
        out |= {int(i): (int(n), int(c)) for i, n, c in zip(ids, near.sum(1), at, strict=True)}
    return out


def crowd(seed=0):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=16).astype(np.float32).tolist(), i % 3) for i in range(300)]
    for k in range(120):
        i, v, label = rows[int(rng.integers(300))]
        rows.append((1000 + k, (np.array(v) + rng.normal(0, 0.15, 16)).astype(np.float32).tolist(), label))
    rows += [(2000 + k, rows[5][1], rows[5][2]) for k in range(200)]  # a third of the rows
    rows += [(3000 + k, (2.0 * np.array(rows[5][1])).tolist(), rows[5][2]) for k in range(3)]
    return rows


@pytest.mark.parametrize("settings", [{}, {"cell_rows": 12, "max_pivots": 60, "tile": 9}])
def test_all_links_of_a_crowd(spark, settings):
    rows = crowd()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    got = {r.vec_id: (r.n_links, r.component_id) for r in metric_join.near_vectors(df, 0.93, **settings).collect()}
    assert got == plain(rows, 0.93)


def test_registered_query(spark):
    from themewell.llm import queries

    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = queries.op2_metric_range_join(spark, SF).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == plain(rows, 0.93)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_odd_rows(spark):
    one, nan, inf = [1.0, 0.0], [float("nan"), 1.0], [float("inf"), 1.0]
    rows = [(1, one, 1, 5), (2, [2.0, -0.0], 1, 5), (3, one, None, 5), (4, None, 1, 5), (5, [], 1, 5), (6, [0.0, 0.0], 1, 5),
            (7, nan, 1, 5), (8, inf, 1, 5), (9, [1.0, None], 1, 5), (None, one, 1, 5), (10, [1.0, 0.0, 0.0], 1, 5),
            (11, one, 2, 5), (1, one, 1, 5), (12, [1e-200, 0.0], 1, 5), (13, [1e200, 1e190], 1, 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, node long")
    got = sorted(((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in metric_join.near_vectors(df).collect()))
    linked = {1: 4, 2: 4, 12: 4, 13: 4}
    want = [(-1, 0, None, None)] + [(i, linked.get(i, 0), 1 if i in linked else i, i not in (2, 12, 13)) for i in [1, *range(1, 14)]]
    assert got == sorted(want, key=lambda r: (r[0], r[1]))
    assert metric_join.near_vectors(df.limit(0)).collect() == []


@pytest.mark.parametrize("spread", [0.02, 5.0])
def test_cells_never_compute_more_than_all_pairs(spark, spread):
    """Clustered vectors are pruned; for those without structure each pair is still computed once at most."""
    rng = np.random.default_rng(3)
    rows = []
    for c in range(40):
        centre = rng.normal(size=16)
        for k in range(60):
            v = centre + rng.normal(0, spread, 16)
            rows.append((c * 60 + k, v.tolist(), 0))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    one = metric_join.work(df, cell_rows=10_000, tile=100).first()
    many = metric_join.work(df, cell_rows=50, tile=100).first()
    assert one.vectors == many.vectors == len(rows) and one.all_pairs == 2400 * 2401 // 2
    assert many.copies > one.copies == 2400
    assert many.computed <= 1.15 * one.all_pairs
    if spread < 1:
        assert many.computed <= 0.5 * one.computed
