import hashlib
import tracemalloc

import pytest
import xxhash

from samples import ODD, docs_of, none, odd  # noqa: F401

from themewell.llm import grace


def plain(rows):
    """Groups by text, in Python."""
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep, sha = max(known, default=None), hashlib.sha256(t.encode()).hexdigest()
        out += [(i, keep, len(ids), sha) for i in ids]
    return out


def key(row):
    return tuple((x is None, x or 0) for x in row[:3]) + tuple(row[3:])


@pytest.mark.parametrize("budget,code", [(1 << 20, None), (64, None), (64, lambda x: len(x) % 3 << 61), (64, lambda x: 5)])
def test_groups_whatever_the_hash(docs_of, odd, budget, code):
    more = [(100 + i, f"text {i % 17}", "en", "a") for i in range(200)] + [(900 + i, "hot", "en", "a") for i in range(150)]
    extra = {} if code is None else {"hash64": code}
    got = grace.deduplicate(odd.union(docs_of(more)), budget=budget, **extra).collect()
    rows = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got]
    assert sorted(rows, key=key) == sorted(plain([*ODD, *more]), key=key)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_empty(none):
    assert grace.deduplicate(none).collect() == []


def test_table_compares_contents_of_equal_codes():
    table = grace.ContentTable(slots=2)
    assert [table.add(3, b"a"), table.add(3, b"b"), table.add(3, b"a"), table.add(7, b"c")] == [
        (0, True), (1, True), (0, False), (2, True)]


def test_the_budget_counts_what_short_texts_hold():
    texts = [b"%08d" % i for i in range(200_000)]
    codes = [xxhash.xxh64_intdigest(t) for t in texts]
    tracemalloc.start()
    table, ids, counts, last = grace.ContentTable(), [], [], []
    for i, (code, text) in enumerate(zip(codes, texts, strict=True)):
        table.add(code, bytes(bytearray(text)))
        ids.append(i + (1 << 40))
        counts.append(1)
        last.append((i + (1 << 41), i + (1 << 40)))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held <= table.bytes <= 4 * held


def test_many_short_texts_are_parted(docs_of):
    docs = docs_of([(i, str(i % 3000), "en", "web") for i in range(6000)])
    got = grace.deduplicate(docs, budget=100_000).collect()
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got} == {(i, i % 3000 + 3000, 2, i >= 3000) for i in range(6000)}
