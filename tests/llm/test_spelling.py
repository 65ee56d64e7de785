import re
import zlib
from collections import Counter

import numpy as np
from samples import SF, docs_of, none, odd  # noqa: F401

from themewell.llm import spelling


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, errors=199):
    words = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % errors == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    words = {w: n for w, n in words.items() if len(w) >= 6 and n >= 5}
    form, beside = {}, {}
    for w, n in words.items():
        others = [x for x in words if abs(len(x) - len(w)) <= 1 and near(w, x)]
        beside[w] = len(others)
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        yield w, form[w], root, n, beside[w], words.get(form[w])


def check(docs, rows):
    got = spelling.variants(docs).collect()
    want = list(brute(rows))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    return want


def test_given_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = check(docs, [(r.doc_id, r.text) for r in docs.collect()])
    assert any(f for _, f, *_ in want)


def test_made_variants_chains_and_ties(docs_of):
    rng = np.random.default_rng(3)
    letters = list("abcdeéß")
    base = ["".join(rng.choice(letters, int(rng.integers(6, 9)))) for _ in range(25)]
    texts, i = [], 0
    for w in base:
        for n in (130, 26, 26, 5):
            texts += [(i := i + 1, " ".join([w] * n), "en", "a")]
            at, x = int(rng.integers(len(w))), str(rng.choice(letters))
            w = [w[:at] + w[at + 1 :], w[:at] + x + w[at:], w[:at] + x + w[at + 1 :]][int(rng.integers(3))]
    texts += [(0, "Banana, BANANA;banana-banana bananaÄ " * 9, "en", "a"), (None, "no ID here " * 9, "en", "a")]
    want = check(docs_of(texts), [(d, t) for d, t, *_ in texts])
    assert any(root not in (w, form) for w, form, root, *_ in want)  # a chain of two


def test_odd_and_empty(odd, none):
    assert {r.word for r in spelling.variants(odd).collect()} == {"wörter"}
    assert spelling.variants(none).collect() == []


def test_signatures_of_close_multisets_meet():
    """Any two vectors at distance d share a signature of distance d, whatever the order of the letters."""
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("aabcdefgÿ"), int(rng.integers(1, 12)))) for _ in range(150)]
    multiset = [frozenset((c, k) for c, n in Counter(w).items() for k in range(n)) for w in words]
    for distance in (1, 2):
        marks = [set(row) for row in spelling.signatures(words, distance).tolist()]
        met = far = 0
        for i in range(len(words)):
            for j in range(i):
                if len(multiset[i] ^ multiset[j]) <= distance:
                    assert marks[i] & marks[j]
                    met += 1
                else:
                    far += bool(marks[i] & marks[j])
        assert met > 20 and far < 150 * 149 / 2 / 3


def test_counts_are_handed_on(docs_of, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 3)
    docs = docs_of([(i, "gamma gammas lambda lambdas epsilon", "en", "a") for i in range(9)], partitions=1)
    assert {(r.word, r.n) for r in spelling.vocabulary(docs, errors=None).collect()} == {(w, 9) for w in ("gammas", "lambda", "lambdas", "epsilon")}
