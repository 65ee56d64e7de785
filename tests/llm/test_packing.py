import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from samples import ODD, SF, docs_of, none, odd  # noqa: F401

from themewell.llm import packing, tokens


def check(rows, pieces, tiers=packing.TIERS):
    """Each id in one piece, windows gapless and within their tier."""
    t = Tokenizer.from_file(tokens.word_vocabulary())
    want = sorted(
        (i is None, i or 0, np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for i, x, *_ in rows
    )
    windows, texts = {}, {}
    for p in pieces:
        assert len(p.ids) == 4 * p.length > 0
        windows.setdefault(p.sequence_id, []).append(p)
        texts.setdefault((p.doc_id is None, p.doc_id or 0), []).append(p)
    got = []
    for key, parts in texts.items():
        parts = sorted(parts, key=lambda p: p.start)
        open_rows = []  # rows that repeat an id are put together from pieces in any order: their texts are equal here
        for p in parts:
            row = next((r for r in open_rows if sum(map(len, r)) == 4 * p.start), None)
            if row is None:
                open_rows.append(row := [])
            row.append(bytes(p.ids))
        got += [(*key, b"".join(r)) for r in open_rows]
        assert {p.doc_tokens for p in parts} == {len(b"".join(r)) // 4 for r in open_rows}
    assert sorted(got) == want
    short = 0
    for parts in windows.values():
        parts = sorted(parts, key=lambda p: p.offset)
        ends = np.cumsum([p.length for p in parts])
        assert [p.offset for p in parts] == [0, *ends[:-1]]
        assert {p.tier for p in parts} <= set(tiers) and ends[-1] <= parts[0].tier
        short += ends[-1] < parts[0].tier
    return short


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pieces = packing.pack(docs)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert check(rows, pieces.collect()) <= docs.rdd.getNumPartitions()
    one = packing.with_checksums(pieces).where("doc_id = 5").first()
    same = pieces.where("doc_id = 5").first()
    assert one.ids_crc32 == zlib.crc32(bytes(same.ids))


def test_odd_rows_in_small_lots(odd, none):
    check(ODD, packing.pack(odd, tiers=(4, 8, 32), lot_tokens=40).collect(), (4, 8, 32))
    assert packing.pack(none).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_windows_are_full_and_gaps_filled(seed):
    rng = np.random.default_rng(seed)
    packer, windows, lengths = packing.Packer((16, 64, 256)), [], rng.integers(1, 700, 200)
    for doc, n in enumerate(lengths):
        windows += packer.add(doc, int(n))
        if doc % 50 == 49:
            windows += packer.pack()
    assert all(sum(p.length for p in w.pieces) == w.tier for w in windows)
    windows += packer.finish()
    assert sum(sum(p.length for p in w.pieces) < w.tier for w in windows) <= 1
    seen = np.zeros((200, 700), int)
    for w in windows:
        for p in w.pieces:
            seen[p.doc, p.start : p.start + p.length] += 1
    assert all((seen[d, :n] == 1).all() and (seen[d, n:] == 0).all() for d, n in enumerate(lengths))
    cuts = sum(len(w.pieces) for w in windows) - 200
    assert cuts < sum(lengths) / 256 + len(windows)


def test_steps_are_balanced():
    windows = [packing.Window(t) for t in (4096,) * 50 + (1024,) * 40 + (256,) * 64]
    steps = packing.step_groups(windows)
    load = np.bincount(steps, weights=[w.tier for w in windows])
    assert load.max() - load.min() <= 4096 and len(load) == round(load.sum() / 32768)
