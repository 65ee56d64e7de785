import re

import numpy as np

from samples import ODD, SF, docs_of, none, odd  # noqa: F401

from themewell.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_targets_refill():
    assert mixing.targets([100, 100, 100], [5, 2, 1]) == [200, 500 / 3, 250 / 3]
    assert mixing.targets([0, 10], [5, 2]) == [0, 15]
    assert mixing.targets([0], [5]) == [0] and mixing.targets([], []) == []


def test_tree_keeps_counts_and_draws_as_an_urn():
    rng = np.random.default_rng(0)
    quotas = mixing.split_quotas([100, 7, 0, 33], 5, rng)
    assert quotas.sum(0).tolist() == [100, 7, 0, 33] and quotas.sum(1).tolist() == [28] * 5
    # Mean and variance of the first shard's count of one source against the hypergeometric ones.
    first = np.array([mixing.split_quotas([30, 50], 4, rng)[0, 0] for _ in range(3000)])
    mean, var = 20 * 30 / 80, 20 * (30 / 80) * (50 / 80) * (60 / 79)
    assert abs(first.mean() - mean) < 0.15 and abs(first.var() - var) < 0.4


def test_query_meets_targets_and_reruns_agree(spark):
    from themewell.llm import queries

    rows = queries.op3_splitting_tree_mix(spark, SF).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r["size"] == len(WORD.findall(docs[r.doc_id].text or "")) for r in rows)
    assert all(0 <= r.taken <= 2 * r["size"] for r in rows)
    sources = sorted({d.source for d in docs.values()})
    sizes = [sum(r["size"] for r in rows if docs[r.doc_id].source == s) for s in sources]
    for s, size, target in zip(sources, sizes, mixing.targets(sizes, [(5, 2, 1)[i % 3] for i in range(len(sources))]), strict=True):
        own = [r for r in rows if docs[r.doc_id].source == s]
        assert {(r.source_size, r.target) for r in own} == {(size, target)}
        assert abs(sum(r.taken for r in own) - target) <= 0.5
    again = queries.op3_splitting_tree_mix(spark, SF).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_pieces_are_what_tree_and_permutation_say(docs_of):
    """Replays the plan in plain Python: positions, blocks, their permutation, the shards' turns."""
    rng = np.random.default_rng(5)
    rows = [(i, "w " * int(rng.integers(0, 60)), "en", "abc"[i % 3]) for i in range(400)]
    size = {i: len(t.split()) for i, t, *_ in rows}
    docs, w = docs_of(rows), 50
    documents, pieces = mixing.plan(docs, shards=4, block_words=w)
    got = pieces.collect()
    lines = {r["name"]: r for r in mixing.recipe(docs.selectExpr("source", "size(array_remove(split(text, ' '), '')) size"), 4, w, 42)[0].collect()}
    hashes = docs.sparkSession.range(400).selectExpr("id block").crossJoin(docs.sparkSession.range(6).selectExpr("id % 2 pass", "id div 2 rank"))
    dice = {(r.rank, r["pass"], r.block): r.h for r in hashes.selectExpr("*", "xxhash64(44, rank, int(pass), block) h").collect()}
    covered = {}
    for r in got:
        line = lines[r.source]
        whole, quota = line["source_size"] // w, line["quotas"][r["pass"]]
        order = sorted(range(whole), key=lambda b: (dice[line["rank"], r["pass"], b], b))
        turn = order.index(r.block) if r.block < whole else whole
        in_source = turn + (line["turns"][0] if r["pass"] else 0)
        assert r["shard"] == sum(b <= in_source for b in line["bounds"]) - 1
        first = r.position + r.start
        assert r.block == first // w == (first + r.taken - 1) // w and r.start + r.taken <= r["size"] == size[r.doc_id]
        assert first + r.taken <= r.block * w + min(w, quota - turn * w)
        for word in range(first, first + r.taken):
            assert covered.setdefault((r.source, r["pass"], word), r.doc_id) == r.doc_id
    assert len(covered) == sum(r.taken for r in got) == sum(line["quota"] for line in lines.values())
    taken = {r.doc_id: r.taken for r in documents.collect()}
    assert taken == {i: sum(r.taken for r in got if r.doc_id == i) for i in size}
    words = [sum(r.taken for r in got if r["shard"] == k) for k in range(4)]
    assert max(words) - min(words) < 0.3 * np.mean(words)


def test_another_seed_takes_other_words(docs_of):
    docs = docs_of([(i, "w " * 30, "en", "abcd"[i % 4]) for i in range(100)])
    a, b = ({(r.doc_id, r.taken) for r in mixing.plan(docs, shards=2, block_words=40, seed=s)[0].collect()} for s in (1, 2))
    assert a != b and sum(t for _, t in a) == sum(t for _, t in b)


def test_columns_that_cannot_be_hashed(docs_of):
    docs = docs_of([(i, f"some words {i}", "en", "a") for i in range(5)]).selectExpr("*", "map('k', doc_id) AS facts")
    mixed = mixing.mix(docs, shards=2)
    assert mixed.columns == docs.columns and all(r.facts == {"k": r.doc_id} for r in mixed.collect())


def test_mixed_texts(docs_of, odd, none):
    mixed = mixing.mix(odd, shards=2, block_words=100)
    assert mixed.columns == odd.columns
    _, pieces = mixing.plan(odd, shards=2, block_words=100)
    got = mixed.collect()
    assert sum(len(WORD.findall(r.text)) for r in got) == sum(r.taken for r in pieces.collect())
    originals = {}
    for i, t, *_ in ODD:
        originals.setdefault(i, set()).add(t)
    assert all(any(o and r.text in o for o in originals[r.doc_id]) and len(r.text) == r.n_chars for r in got)
    assert mixing.mix(none).collect() == [] and mixing.plan(none)[0].collect() == []


def test_recipe_in_groups_meets_targets_and_shares(spark, docs_of, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 7)
    monkeypatch.setattr(mixing, "FEW_SOURCES", 10)
    rng = np.random.default_rng(6)
    rows = [(i, "w " * int(rng.pareto(1.0) * 20 % 3000), "en", None if i % 50 == 0 else f"s{i % 50:02d}") for i in range(400)]
    docs = docs_of(rows)
    sized = docs.selectExpr("source", "size(array_remove(split(text, ' '), '')) size")
    lines = sorted(mixing.recipe(sized, 4, 50, 1)[0].collect(), key=lambda r: r["rank"])
    names = [f"s{i:02d}" for i in range(1, 50)] + [None]
    assert [(r["name"], r["rank"]) for r in lines] == list(zip(names, range(50), strict=True))
    sizes = [sum(len(t.split()) for _, t, _, s in rows if s == n) for n in names]
    assert [r["target"] for r in lines] == mixing.targets(sizes, [(5, 2, 1)[i % 3] for i in range(50)])
    assert [r["base"] for r in lines] == [sum(r["passes"] * r["source_size"] for r in lines[:i]) for i in range(50)]
    bounds = np.array([r["bounds"] for r in lines])
    assert bounds[:, -1].tolist() == [r["blocks"] for r in lines] and (np.diff(bounds, axis=1) >= 0).all()
    total = np.diff(bounds, axis=1).sum(0)
    assert total.max() - total.min() <= 2
    documents, pieces = mixing.plan(docs, shards=4, block_words=50)
    taken = pieces.groupBy("source").sum("taken").collect()
    want = {r["name"]: r["quota"] for r in lines if r["quota"]}
    assert {r[0]: r[1] for r in taken} == want and documents.count() == 400


def test_groups_of_sources_draw_as_an_urn():
    rng = np.random.default_rng(1)
    first = []
    for _ in range(3000):  # the groups first, then the sources of one of them
        groups = mixing.split_quotas([50, 30], 4, rng)
        one = mixing.split_quotas([20, 30], 4, rng, groups[:, 0].tolist())
        assert one.sum(0).tolist() == [20, 30] and (one.sum(1) == groups[:, 0]).all()
        first.append(one[0, 0])
    mean, var = 20 * 20 / 80, 20 * (20 / 80) * (60 / 80) * (60 / 79)
    assert abs(np.mean(first) - mean) < 0.15 and abs(np.var(first) - var) < 0.4


def test_more_than_100_000_sources(spark):
    docs = spark.range(100_500).selectExpr("id doc_id", "repeat('w ', int(id % 5)) text", "concat('host', id) source")
    documents, pieces = mixing.plan(docs, block_words=64)
    sizes = [int(name[4:]) % 5 for name in sorted(f"host{i}" for i in range(100_500))]
    want = mixing.targets(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))])
    assert documents.count() == 100_500
    assert documents.groupBy().sum("taken").first()[0] == sum(map(round, want))
    assert pieces.groupBy("shard").count().count() == 16
