import hashlib
import zlib

import pytest
from pyspark.sql import functions as F
from samples import ODD, docs_of, none, odd  # noqa: F401

from themewell.llm import merkle


def _hash(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([_hash("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def _beside(levels, i):
    for level in levels[:-1]:
        start = i // 16 * 16
        yield level[start:i], level[i + 1 : start + 16]
        i //= 16


def brute(rows, tampered):
    """What ``manifest`` returns, tree by tree in plain Python."""
    by_source = {}
    for r in rows:
        low = None if r.text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text)
        facts = "".join(map(_field, (r.doc_id, r.source, r.lang, r.n_chars)))
        other = low if tampered(r.doc_id) else r.text
        by_source.setdefault(r.source, []).append((r.doc_id, _hash(facts + _field(r.text)), _hash(facts + _field(other))))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by_source[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = _levels([x[1] for x in by_source[s]])
    top = _levels([trees[s][-1][0] for s in names])
    root = top[-1][0] if names else None
    for k, s in enumerate(names):
        for i, (doc_id, leaf, folded) in enumerate(by_source[s]):
            proof = ""
            for before, after in (*_beside(trees[s], i), *_beside(top, k)):
                proof += "".join(before + after)
                folded = _hash("".join(before) + folded + "".join(after))
            yield doc_id, leaf, trees[s][-1][0], root, _hash(proof), folded, folded == root


def fifth(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def check(docs, tampered=fifth):
    got = merkle.manifest(docs, merkle.every_fifth(F.col("doc_id"))).collect()
    want = list(brute(docs.collect(), tampered))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    return got


def test_odd_rows(odd):
    got = check(odd)
    assert len(got) == len(ODD) and len({r.root for r in got}) == 1


def test_empty(none):
    assert merkle.manifest(none).collect() == []


@pytest.mark.parametrize("n", [1, 16, 17, 257])
def test_one_source(docs_of, n):
    rows = check(docs_of([(i, f"Text {i}", "en", "a") for i in range(n)]))
    for r in rows:
        assert r.subroot == r.root and r.verified == (not fifth(r.doc_id))
    if n == 1:
        assert rows[0].proof_sha256 == _hash("") and rows[0].leaf == rows[0].root


def test_many_sources_of_odd_heights(docs_of):
    """A hot source beside lone leaves, more sources than a run holds, null among them."""
    rows = [(i, f"T{i}" if i % 3 else None, None if i % 4 else "de", "hot" if i % 3 == 0 else f"s{i % 37:02d}") for i in range(700)]
    rows += [(1000 + i, "A lone text", "en", f"lone{i}") for i in range(3)] + [(2000, "x", "en", None), (2000, "x", "en", None)]
    check(docs_of(rows, partitions=7))


def test_a_proof_folds_to_the_root(docs_of):
    docs = docs_of([(i, f"Text {i}", "en", "ab"[i % 2]) for i in range(40)])
    rows = merkle.manifest(docs, proofs=True).collect()
    assert all(r.verified and _hash(r.proof) == r.proof_sha256 and len(r.proof) % 64 == 0 for r in rows)
    assert {len(r.proof) // 64 for r in rows} == {15 + 1 + 1, 3 + 1 + 1}  # runs of 16 and 4, two of them, two sources


def test_hot_runs_are_stored_by_chunks(docs_of, monkeypatch):
    monkeypatch.setattr(merkle, "CHUNK", 20)
    check(docs_of([(i, f"Text {i}", "en", "hot" if i % 3 else f"s{i}") for i in range(150)]))


def test_the_session_keeps_its_limit(spark, docs_of):
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key)
    merkle.manifest(docs_of([(1, "a", "en", "a")]))
    assert spark.conf.get(key) == before
