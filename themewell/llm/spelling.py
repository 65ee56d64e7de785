"""Spelling variants: words one edit apart, found by PartEnum signatures of their letter multisets.

A word's letters are a binary vector: its k-th letter of a kind is one dimension.
One replaced letter changes two dimensions, one letter more or less changes one.
Dimensions are dealt over ``p`` partitions; vectors that differ in ``d`` of them
agree on all but ``d`` partitions, so there is one signature for each choice of
``p - d`` partitions, and two words within the distance share one. Distances of
one and two have signatures of their own, as they go with lengths that differ by
one and by none. The letters' order narrows a signature down: of a word with one
edit, the half without it stays as it was, so this half is part of the key.

Signatures are equi-joined, and each meeting is checked by the real edit
distance inside the join: pairs that fail are never rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themewell.llm.arrow import batch_of, map_batches, texts_of
from themewell.session import cut

PARTITIONS = 4
LEAST_LENGTH = 6
LEAST_COUNT = 5
FACTOR = 5  # a form is so many times as frequent as its variant
ERRORS = 199  # a run in so many loses a letter, by its hash
HELD = 200_000  # words a task counts before it hands the counts on

_RUNS = re.compile("[A-Za-zÀ-ÿ]+")


# ---- counts -----------------------------------------------------------------


def runs_of(doc_id: int | None, text: str | None, errors: int | None = ERRORS) -> Counter:
    """How often each lower-cased run stands in a text; runs whose hash ``errors`` divides lose one letter.

    The hash is the crc32 of id, colon and run; a missing id counts as empty.
    """
    if not text:
        return Counter()
    # On bytes: A-Z only.
    found = Counter(_RUNS.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
    if errors is None:
        return found
    before = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for run, n in found.items():
        h = zlib.crc32(run.encode(), before)
        if h % errors == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        out[run] += n
    return out


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, errors: int | None = ERRORS) -> DataFrame:
    """(word, n): the words of all texts with at least so many code points and occurrences."""

    def make(schema: pa.Schema):
        def run(batches: Iterator[pa.RecordBatch]):
            held: Counter = Counter()

            def handed() -> pa.RecordBatch:
                kept = [(w, n) for w, n in held.items() if len(w) >= least_length]
                held.clear()
                return batch_of(schema, {"word": [w for w, _ in kept], "n": [n for _, n in kept]})

            for batch in batches:
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                    held.update(runs_of(doc_id, text.as_py(), errors))
                    if len(held) >= HELD:
                        yield handed()
            yield handed()

        return run

    counts = map_batches(texts_of(docs), make, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# ---- signatures -------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well mixed 64-bit values, by the finalizer of SplitMix64."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grouped_sums(values: np.ndarray, rows: np.ndarray, parts: np.ndarray, n: int, p: int) -> np.ndarray:
    out = np.zeros((n, p), np.uint64)
    np.add.at(out, (rows, parts), values)
    return out


def projections(words: list[str], p: int = PARTITIONS) -> np.ndarray:
    """(word, partition): a hash of the letters of each word that lie in the partition, whatever their order."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
    rows = np.repeat(np.arange(len(words)), [len(w) for w in words])
    # Equal letters of a word side by side, in order, to number them.
    order = np.lexsort((points, rows))
    r, c = rows[order], points[order]
    new = np.ones(len(c), bool)
    new[1:] = (r[1:] != r[:-1]) | (c[1:] != c[:-1])
    starts = np.flatnonzero(new)
    nth = np.arange(len(c)) - np.repeat(starts, np.diff(np.append(starts, len(c))))
    dimension = _mixed((c << np.uint64(32)) | nth.astype(np.uint64))
    return _grouped_sums(_mixed(dimension), r, (dimension % np.uint64(p)).astype(np.int64), len(words), p)


def signatures(words: list[str], distance: int, p: int = PARTITIONS) -> np.ndarray:
    """(word, choice): a signature for each choice of ``p - distance`` partitions.

    Words whose letter multisets differ in at most ``distance`` dimensions agree in one at least.
    """
    parts = projections(words, p)
    whole = parts.sum(axis=1, dtype=np.uint64)
    left_out = list(combinations(range(p), distance))
    found = [_mixed(whole - parts[:, list(out)].sum(axis=1, dtype=np.uint64)) + np.uint64(k) for k, out in enumerate(left_out)]
    return np.stack([_mixed(x) for x in found], axis=1)


def _halves(words: list[str], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first half and of the rest, where words are compared at ``lengths``."""
    first = [zlib.crc32(w[: n // 2].encode()) for w, n in zip(words, lengths.tolist(), strict=True)]
    last = [zlib.crc32(w[len(w) - (n - n // 2) :].encode()) for w, n in zip(words, lengths.tolist(), strict=True)]
    return np.array(first, np.uint64), np.array(last, np.uint64)


#: Roles in a join: both sides of a replacement, the shorter and the longer side of an insertion.
SAME, SHORT, LONG = 0, 1, 2


def entries(words: DataFrame, p: int = PARTITIONS) -> DataFrame:
    """(key, role, word, n): the keys under which the words of ``words`` (word, n) meet."""

    def make(schema: pa.Schema):
        def run(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                texts = batch.column("word").to_pylist()
                if not texts:
                    continue
                lengths = np.array([len(w) for w in texts])
                for role, distance, compared in ((SAME, 2, lengths), (SHORT, 1, lengths), (LONG, 1, lengths - 1)):
                    marks = signatures(texts, distance, p)
                    for side, half in enumerate(_halves(texts, compared)):
                        about = np.uint64(4 * distance + side) + (compared.astype(np.uint64) << np.uint64(8))
                        keys = _mixed(marks + _mixed(half + (about << np.uint64(32)))[:, None])
                        for k in range(keys.shape[1]):
                            yield batch_of(
                                schema,
                                {"key": pa.array(keys[:, k].view(np.int64)), "role": [role] * len(texts),
                                 "word": batch.column("word"), "n": batch.column("n")},
                            )

        return run

    return map_batches(words, make, "key long, role int, word string, n long")


def near_pairs(words: DataFrame, p: int = PARTITIONS) -> DataFrame:
    """(word, n, other, other_n): all pairs of different words exactly one edit apart, in both directions, once each."""
    met = cut(entries(words, p))
    left = met.where(F.col("role") != LONG).select("key", "role", F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = met.where(F.col("role") != SHORT).select(
        F.col("key").alias("other_key"), F.col("role").alias("other_role"), F.col("word").alias("b"), F.col("n").alias("b_n")
    )
    roles = (F.col("role") == SAME) & (F.col("other_role") == SAME) & (F.col("a") < F.col("b"))
    roles |= (F.col("role") == SHORT) & (F.col("other_role") == LONG)
    near = F.levenshtein("a", "b", 1) == 1
    pairs = left.join(right, (F.col("key") == F.col("other_key")) & roles & near).select("a", "a_n", "b", "b_n").distinct()
    ends = F.array(
        F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("other"), F.col("a_n").alias("other_n")),
    )
    return pairs.select(F.explode(ends).alias("x")).select("x.*")


# ---- groups -----------------------------------------------------------------


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last one; each step halves the way that is left. Counts grow, so there are no rings."""
    step = forms.select("word", F.col("form").alias("root"))
    while True:
        onward = step.select(F.col("word").alias("at"), F.col("root").alias("next"))
        step = cut(step.join(onward, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        ))
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        step = step.drop("moved")


def variants(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    factor: int = FACTOR,
    errors: int | None = ERRORS,
    p: int = PARTITIONS,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per word of the texts' vocabulary.

    Words are the runs of Latin letters, only A-Z lower-cased, of ``least_length``
    code points and ``least_count`` occurrences; ``errors`` is the rate of made
    misspellings (None: texts as they are). ``form`` is the most frequent word
    one edit away (the first in code-point order of equals) if it is ``factor``
    times as frequent, else null; ``root`` is where forms lead in the end.

    Null and empty texts have no words, a null id counts as an empty one, rows
    that repeat count again, and a table without words gives no rows. Other
    columns are not read.
    """
    words = cut(vocabulary(docs, least_length, least_count, errors))
    # Least of (-n, word): largest count, first word.
    best = near_pairs(words, p).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other"))).alias("best")
    )
    joined = words.join(best.withColumnRenamed("word", "of"), F.col("word") == F.col("of"), "left")
    enough = -F.col("best.minus") >= F.col("n") * F.lit(factor)
    found = cut(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.minus")).alias("form_n"),
    ))
    roots = _roots(found.where("form is not null")).withColumnRenamed("word", "of")
    whole = found.join(roots, F.col("word") == F.col("of"), "left")
    return whole.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
