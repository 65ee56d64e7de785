import numpy as np
from pyspark.sql import functions as F
from samples import ODD, SF, docs_of, none, odd  # noqa: F401

import corpus_pipeline
from themewell.llm import language, simhash, tokens


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "mix", "pack"]


def test_every_stage_takes_odd_rows_and_empty_tables(spark, odd, none):
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            out.collect()
            if name != "pack":
                assert out.schema.simpleString() == docs.schema.simpleString(), name


def test_language_drops_what_is_rejected_only(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.identify_language(spark, docs, SF)
    model = language.fit(docs, language.may_learn(docs["doc_id"]))
    scorer = language.Scorer(model)
    good = [r for r in docs.collect() if (s := scorer.score(r.text))[0] != "und" and s[1] >= model.threshold]
    assert rows_of(kept) == sorted(map(tuple, good), key=repr)
    assert kept.count() >= 0.97 * docs.count()


def test_one_row_of_equal_texts_stays(spark, odd):
    got = corpus_pipeline.drop_copies(spark, odd, SF).collect()
    want = {}
    for i, t, *_ in ODD:
        key = t or ""
        if key not in want or (i is not None and (want[key] is None or i > want[key])):
            want[key] = i
    assert sorted(((r.text or ""), r.doc_id or -1) for r in got) == sorted((t, i or -1) for t, i in want.items())


def test_near_copies_go_and_others_stay(spark, docs_of):
    rng = np.random.default_rng(8)
    vocabulary = [f"word{i}" for i in range(3000)]
    rows = []
    for k in range(60):
        words = rng.choice(vocabulary, int(rng.integers(400, 900))).tolist()
        rows.append((k, " ".join(words), "en", "a"))
        if k < 30:
            words[len(words) // 2] = "changed"
            rows.append((1000 + k, " ".join(words), "en", "b"))
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs_of(rows), SF).collect()}
    # All pairs of fingerprints, group by group.
    fps = np.array([simhash.fingerprint(simhash.shingle_hashes(t, 3))[0] for _, t, *_ in rows])
    near = np.bitwise_count(fps[:, None] ^ fps[None]) <= 3
    ids = np.array([i for i, *_ in rows])
    least = ids.copy()
    for _ in rows:
        least = np.where(near, least[None], 10_000).min(1)
    assert kept == set(ids[least == ids].tolist())
    assert set(range(60)) <= kept and len(kept) < 85


def test_columns_named_like_those_of_the_stages(spark, odd):
    docs = odd.withColumnsRenamed({"code": "_key", "bucket": "_kept"}).withColumns({"_gone": F.lit(1), "_mix": F.lit("m")})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert {(r["_key"], r["_kept"], r["_gone"], r["_mix"]) for r in out.collect()} <= {(7, "x", 1, "m")}


def test_whole_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema).coalesce(3)
        stages.append((name, docs.count()))
    assert stages[0][1] >= stages[1][1] >= stages[2][1] > 0
    pieces = corpus_pipeline.run(spark, SF).collect()
    want, got = {}, {}
    for r in docs.collect():
        want.setdefault(r.doc_id, []).append(r.text)
    for p in pieces:
        got[p.doc_id] = got.get(p.doc_id, 0) + p.length
    assert set(got) == set(want)
    encode = tokens.WordEncoder(tokens.word_vocabulary(), False).encode
    assert got == {i: sum(len(encode(t)) + 1 for t in ts) for i, ts in want.items()}
    windows = {}
    for p in pieces:
        windows.setdefault(p.sequence_id, []).append((p.offset, p.length, p.tier))
    for parts in windows.values():
        parts.sort()
        ends = np.cumsum([n for _, n, _ in parts])
        assert [o for o, _, _ in parts] == [0, *ends[:-1]] and ends[-1] <= parts[0][2]
