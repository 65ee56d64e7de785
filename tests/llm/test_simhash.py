import numpy as np
import pytest
import xxhash

from samples import SF, docs_of, none, odd  # noqa: F401

from themewell.llm import simhash


def plain_fingerprint(text, width):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ")
             .replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
    runs = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    votes = [0] * 64
    for r in runs:
        h = xxhash.xxh64_intdigest(r.encode(), 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(runs))


def linked(fps, radius):
    """Smallest index reachable, by repeated passes over all pairs."""
    near = np.bitwise_count(fps[:, None] ^ fps[None]).reshape(len(fps), len(fps), -1).sum(2) <= radius
    at = np.arange(len(fps))
    while True:
        new = np.minimum(at, np.where(near, at[None], len(fps)).min(1))
        if (new == at).all():
            return at
        at = new


def test_registered_query_against_all_pairs(spark):
    from themewell.llm import queries

    got = sorted(tuple(r) for r in queries.op10_simhash_multi_index(spark, SF).collect())
    rows = sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda r: r.doc_id)
    fps = np.array([plain_fingerprint(r.text, 3) for r in rows], np.uint64)
    first = linked(fps, 3)
    want = [(r.doc_id, f"{int(f):016x}", rows[a].doc_id) for r, f, a in zip(rows, fps, first, strict=True)]
    assert got == sorted(want)


@pytest.mark.parametrize("segments,ball,radius,members", [(2, 1, 3, 4096), (2, 1, 3, 3), (3, 2, 8, 2), (4, 1, 7, 5)])
def test_crowded_tables_find_every_link(spark, segments, ball, radius, members):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    fps = []
    for b in base:
        for _ in range(25):
            flips = rng.choice(64, rng.integers(0, 7), replace=False)
            fps.append(b ^ np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64), initial=np.uint64(0)))
    fps = np.unique(np.array(fps, np.uint64))
    nodes = spark.createDataFrame([(i, bytearray(int(f).to_bytes(8, "big"))) for i, f in enumerate(fps)], "id long, fp binary")
    entries = simhash._entries(nodes, 1, segments, ball)
    stored = simhash._entries(nodes, 1, segments, 0)
    tiled = simhash._tiled(entries, stored, 64 // segments, ball, members)
    links = [(r.a, r.b) for r in simhash._meet(tiled, 1, radius).collect()]
    assert all(np.bitwise_count(fps[a] ^ fps[b]) <= radius for a, b in links)
    at = np.arange(len(fps))
    for _ in range(len(fps)):
        for a, b in links:
            at[a] = at[b] = min(at[a], at[b])
    assert at.tolist() == linked(fps, radius).tolist()
    if members == 4096:
        assert len(links) <= 2 * len(fps) * segments  # forests, not pairs


def test_odd_rows(odd, none):
    got = {}
    for r in simhash.near_duplicates(odd).collect():
        got.setdefault(r.doc_id, []).append((bytes(r.fp), r.component_id))
    zero = bytes(8)
    assert got[1] == got[2] == got[3] == [(zero, 1)]
    assert len(got[4]) == 2 and {c for _, c in got[4] + got[5]} == {4}
    assert len(got[None]) == 1 and got[None][0][1] is None
    assert simhash.near_duplicates(none).collect() == []
