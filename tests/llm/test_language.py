import zlib

import numpy as np

from samples import SF, docs_of, none, odd  # noqa: F401

from themewell.llm import language


def test_held_out_accuracy_and_score(spark):
    from themewell.llm import queries

    found = {r.doc_id: r for r in queries.op5_subword_language_id(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert sorted(found) == sorted(r.doc_id for r in docs)
    assert all(found[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in docs)
    held = [(found[r.doc_id], r.lang) for r in docs if found[r.doc_id].held_out]
    assert np.mean([f.lang_pred == lang for f, lang in held]) >= 0.97
    assert all(0 <= f.score <= 1 for f, _ in held)
    # Calibrated: what is rejected is little, and scores are about as high as answers are right.
    assert sum(f.rejected for f in found.values()) <= 0.02 * len(found)
    assert abs(np.mean([f.score for f, _ in held]) - np.mean([f.lang_pred == lang for f, lang in held])) < 0.05


def test_only_the_text_decides_and_odd_rows(spark, docs_of, odd, none):
    rows = [(i, f"the house and the tree {i} of water" if i % 2 else f"das haus und der baum {i} im wasser", "en" if i % 2 else "de", "s")
            for i in range(60)]
    model = language.fit(docs_of(rows))
    assert model.languages == ["de", "en"]
    got = {(r.doc_id): (r.lang_pred, r.score, r.rejected) for r in language.identify(odd, model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0, True)
    assert got[4][0] == got[5][0] == "en" and got[7][0] == "de"
    turned = docs_of([(900 - i, t, "xx", None) for i, t, _, _ in rows])
    a = sorted((r.lang_pred, r.score) for r in language.identify(docs_of(rows), model).collect())
    assert a == sorted((r.lang_pred, r.score) for r in language.identify(turned, model).collect())
    assert language.identify(none, model).collect() == []
    kept = language.keep_identified(odd, model)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()}.isdisjoint({1, 2, 3})


def test_nothing_to_learn_from(odd, none):
    model = language.fit(none)
    assert {(r.lang_pred, r.score) for r in language.identify(odd, model).collect()} == {("und", 0.0)}


def test_words_looked_up_equal_whole_text():
    rng = np.random.default_rng(4)
    model = language.Model(["a", "b", "c"], rng.normal(size=(language.BUCKETS, 3)).astype(np.float32), rng.normal(size=3))
    text = "Größe und größe " + "x" * 300 + " ab ab 12 ab"
    buckets, share, n = language.features(language.words_of(text))
    want = language.softmax(model.logits(share @ model.scores[buckets], n))
    got = language.Scorer(model).score(text)
    assert got[0] == "abc"[want.argmax()] and abs(got[1] - want.max()) < 1e-9


def test_letters_marks_and_numerals():
    assert language.words_of("½ ²① 12 _ \u0301 …") == []
    assert language.words_of("हिन्दी भाषा") == ["हिन्दी", "भाषा"]
    assert language.words_of("L'Été_x2y ÞÆ") == ["l", "été", "x", "y", "þæ"]
    model = language.Model(["a"], np.ones((language.BUCKETS, 1), np.float32), np.zeros(1))
    assert [x for x, _ in language.Scorer(model).score_all(["²①", "½", "x", None])] == ["und", "und", "a", "und"]


def test_subwords_are_the_n_grams_of_each_word():
    words = ["a", "größe", "hi😀", "x" * 90]
    codes, counts = language.subwords(words)
    grams = [[f"<{w}>"[i : i + n] for n in language.NGRAMS for i in range(len(w) + 3 - n)] for w in words]
    assert counts.tolist() == list(map(len, grams))
    bucket = {}  # one bucket for each n-gram, whatever word it stands in
    for gram, code in zip(sum(grams, []), codes.tolist(), strict=True):
        assert bucket.setdefault(gram, code) == code
    assert len(set(bucket.values())) == len(bucket)


def test_forgetting_changes_no_answer():
    rng = np.random.default_rng(9)
    model = language.Model(["a", "b"], rng.normal(size=(language.BUCKETS, 2)).astype(np.float32), np.zeros(2))
    texts = [" ".join("".join(rng.choice(list("abcdefg"), 4)) for _ in range(30)) for _ in range(60)]
    whole = language.Scorer(model).score_all(texts)
    small = language.Scorer(model, remembered=40)
    parts = [x for i in range(0, 60, 3) for x in small.score_all(texts[i : i + 3])]
    assert [x for x, _ in whole] == [x for x, _ in parts]
    assert np.allclose([x for _, x in whole], [x for _, x in parts], atol=1e-12)


def test_any_number_of_languages(docs_of):
    rows = [(i, f"{chr(0x4E00 + i // 4) * 3} wort", f"l{i // 4:03d}", "s") for i in range(4 * 320)]
    assert len(language.fit(docs_of(rows)).languages) == 320
