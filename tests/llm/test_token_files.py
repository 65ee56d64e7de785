import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from samples import ODD, SF, docs_of, none, odd  # noqa: F401

from themewell.llm import token_files, tokens


def reference(path):
    t = Tokenizer.from_file(path)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path,spaced", [(tokens.byte_vocabulary(), True), (tokens.word_vocabulary(), False)])
def test_words_give_the_ids_of_the_whole(path, spaced):
    rng = np.random.default_rng(2)
    signs = list("aBé'.\n\t s1tl\x1c漢,!ſKİΣς́  \0") + ["'s", " 'll", "  ", "<|endoftext|>", "1٣", "\r\n"]
    texts = ["".join(rng.choice(signs, rng.integers(0, 40))) for _ in range(3000)] + [t for _, t, *_ in ODD]
    encoder, whole = tokens.WordEncoder(path, spaced), reference(path)
    for text, ids in zip(texts, encoder.encode_all(texts), strict=True):
        assert encoder.encode(text).tolist() == ids.tolist() == whole(text), repr(text)


def test_memory_forgets_and_stays_right(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    encoder, whole = tokens.WordEncoder(tokens.byte_vocabulary(), True), reference(tokens.byte_vocabulary())
    for text in ("a b c d e f g h i j", "b d f h j k l m", "a b c d e f g h i j"):
        assert encoder.encode(text).tolist() == whole(text)
    assert len(encoder.words) <= 5


def test_table_forgets_and_stays_right(monkeypatch):
    for name, value in (("LEARNED", 40), ("STORED_IDS", 100), ("SLOTS", 128), ("BLOCK_WORDS", 16), ("CHUNK_SIGNS", 300)):
        monkeypatch.setattr(tokens, name, value)
    encoder, whole = tokens.WordEncoder(tokens.byte_vocabulary(), True), reference(tokens.byte_vocabulary())
    rng = np.random.default_rng(3)
    words = [*"abcdefgh", "слово", "naïve", "a-very-long-word-of-signs,", "x" * 16, "x" * 17, "x" * 70, "é" * 8, "1984", "a\nb", "a\n\nb"]
    texts = [" ".join(rng.choice(words, rng.integers(1, 60))) for _ in range(300)]
    for _ in range(2):
        assert all(i.tolist() == whole(t) for t, i in zip(texts, encoder.encode_all(texts), strict=True))
    assert encoder.table.entries <= 40 + 16


def test_words_of_a_text_are_its_own():
    """White space and signs at the ends of neighbours in a chunk do not meet."""
    texts = ["\n", "a\n", "\na", "\t", ".", "'s", "a'", "\0", "", None, "a\n\n", "b"]
    for path, spaced in ((tokens.byte_vocabulary(), True), (tokens.word_vocabulary(), False)):
        encoder, whole = tokens.WordEncoder(path, spaced), reference(path)
        assert [i.tolist() for i in encoder.encode_all(texts)] == [whole(t) for t in texts]
    assert list(encoder.encode_all([])) == []


@pytest.mark.parametrize("values", [[], [0], [255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1, 0], list(range(1000))])
def test_code_round_trip(values):
    ranks = np.array(values, "<u4")
    control, data = token_files.encode_ranks(ranks)
    assert token_files.decode_ranks(control, data, len(ranks)).tolist() == values
    assert len(control) == -(-len(values) // 4)
    block = token_files.pack_block(3, 4, [None, 9], np.array([0, len(values)]), ranks) + b"\n"
    ((shard, number, ids, counts, back),) = token_files.unpack_blocks(block)
    assert (shard, number, ids, counts.tolist(), back.tolist()) == (3, 4, [None, 9], [0, len(values)], values)
    with pytest.raises(ValueError):
        list(token_files.unpack_blocks(block[:-1] + b"x"))


def check(rows, got):
    whole = reference(tokens.byte_vocabulary())
    want, start = [], 0
    for i, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*whole(text), 2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_query_reads_back_what_the_tokenizer_gives(spark):
    from themewell.llm import queries

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(rows, queries.op4_ranked_token_files(spark, SF).collect())


def test_odd_rows_many_blocks(spark, odd, none, tmp_path):
    token_files.write(odd, str(tmp_path / "odd"), block_ids=7)
    check(ODD, token_files.digests(spark, str(tmp_path / "odd")).collect())
    token_files.write(none, str(tmp_path / "none"))
    assert token_files.digests(spark, str(tmp_path / "none")).collect() == []


def test_frequent_ids_take_one_byte(spark, docs_of, tmp_path):
    token_files.write(docs_of([(i, "a b c d", "en", "a") for i in range(50)]), str(tmp_path / "f"))
    blocks = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*")
    contents = [bytes(r.content) for r in blocks.load(str(tmp_path / "f/ids")).collect()]
    ranks = [r for c in contents for *_, r in token_files.unpack_blocks(c)]
    assert max(int(r.max()) for r in ranks) == 4


def test_encoder_equals_the_library_on_odd_strings():
    import random

    from tokenizers import Tokenizer

    rng = random.Random(1)
    signs = [chr(c) for c in range(0x250)] + [
        "  ", "\u2009", "\u3000", "'s", "'LL", "e\u0301", "中", "😀", "‐", "…", "\x1c", "\u212a", "\u212b", "Ɓ", "ﬁ", "ς", "Σ",
        "<|endoftext|>", "<|startoftext|>",
    ]
    texts = ["".join(rng.choice(signs) if rng.random() < 0.6 else rng.choice("abc de 'st,.12\n\t") for _ in range(rng.randint(0, 25))) for _ in range(15_000)]
    for path, spaced in ((tokens.byte_vocabulary(), True), (tokens.word_vocabulary(), False)):
        library = Tokenizer.from_file(path)
        for plain in (False, True):
            library.encode_special_tokens = plain
            encoder = tokens.WordEncoder(path, spaced, plain)
            wanted = [library.encode(t, add_special_tokens=False).ids for t in texts]
            assert [encoder.encode(t).tolist() for t in texts] == wanted
            assert [i.tolist() for i in encoder.encode_all(texts)] == wanted
