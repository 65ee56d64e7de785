"""Language identification by averaged hashed subword embeddings and a linear softmax.

A word is the bag of its character n-grams with marks at its ends, hashed to
buckets. A text is the mean of the embeddings of all its subwords; a linear
softmax gives the languages. Embeddings and weights are trained by stochastic
gradient descent in numpy on a bounded sample of labelled rows. A second part of
the sample sets the temperature of the softmax and the score under which texts
are rejected.

For prediction embedding and weights are multiplied out once: each bucket has a
score per language, each word a sum of scores, which workers remember. New words
of a batch are hashed and summed up together in numpy.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from themewell.llm.arrow import batch_of, bound_batches, map_batches
from themewell.session import cut

UNKNOWN = "und"
BUCKETS = 1 << 16
DIMENSIONS = 16
NGRAMS = (1, 2, 3, 4)
SAMPLE_PER_LANGUAGE = 400  # labelled rows per language for training and calibration, about
FEW_LANGUAGES = 10_000
EPOCHS = 6
RATE = 0.5
TARGET_ERROR = 0.01  # of what is accepted on the calibration rows
MAX_REJECTED = 0.002  # of the calibration rows that are right
REMEMBERED = 200_000  # words in each of two generations that a worker keeps
REMEMBERED_BYTES = 64 << 20  # of scores in a generation, whatever the number of languages

# Letters, with the marks that belong to them; the second form for texts up to U+024F, which have no marks.
_LETTERS = regex.compile(r"\p{M}*\p{L}[\p{L}\p{M}]*")
_LATIN_LETTERS = re.compile("[A-Za-zªµºÀ-ÖØ-öø-ɏ]+")
_BEYOND = re.compile("[^\0-\u024f\u2010-\u2027]")


def words_of(text: str | None) -> list[str]:
    """Runs of letters and their marks, lower-cased; numerals and marks alone are no words."""
    if not text:
        return []
    text = text.lower()
    return _LATIN_LETTERS.findall(text) if _BEYOND.search(text) is None else _LETTERS.findall(text)


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts): the character n-grams of all words, ends marked, repeats included, word by word; how many of each."""
    points = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    lengths = np.array([len(w) + 2 for w in words], np.int64)
    word = np.repeat(np.arange(len(words)), lengths)
    # Characters from a place to the end of its word.
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(points))
    codes, owners = [], []
    gram = np.zeros(len(points), np.uint64)
    for n in NGRAMS:
        last = np.zeros_like(points)
        last[: len(points) - n + 1] = points[n - 1 :]
        gram = gram * np.uint64(0x9E3779B97F4A7C15) + last + np.uint64(1)
        whole = left >= n
        codes.append(_buckets(gram[whole]))
        owners.append(word[whole])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(codes)[order], np.bincount(owner, minlength=len(words))


def _buckets(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(29))) % np.uint64(BUCKETS)).astype(np.int64)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
    """(buckets, shares, n) of a text's words: shares sum to 1, n subwords in all; empty without words."""
    times: dict[str, int] = {}
    for w in words:
        times[w] = times.get(w, 0) + 1
    if not times:
        return np.empty(0, np.int64), np.empty(0), 0
    codes, counts = subwords(list(times))
    buckets, where = np.unique(codes, return_inverse=True)
    total = np.bincount(where, weights=np.repeat(list(times.values()), counts))
    return buckets, total / total.sum(), int(total.sum())


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # bucket x language
    bias: np.ndarray
    temperature: float = 1.0
    doubt: float = 0.0  # subwords that count for nothing: short texts are less sure
    threshold: float = 0.0  # calibrated scores below are rejected

    def logits(self, mean: np.ndarray, n: np.ndarray | float) -> np.ndarray:
        return (mean + self.bias) * (n / (n + self.doubt)) / self.temperature


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[str, str]], seed: int = 42, epochs: int = EPOCHS) -> Model:
    """A model from (text, language) rows in any order; every fourth row only calibrates.

    Without rows there is no language, and everything is unknown.
    """
    rows = sorted((r for r in rows if words_of(r[0])), key=lambda r: (r[1], xxhash.xxh64_intdigest(r[0])))
    languages = sorted({lang for _, lang in rows})
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    number = {lang: i for i, lang in enumerate(languages)}
    rng = np.random.default_rng(seed)
    fit, held = [], []
    for i, (text, lang) in enumerate(rows):
        words = words_of(text)
        whole = (features(words), number[lang])
        if i % 4 != 3:
            fit.append(whole)
        if i % 4 == 3 or len(rows) < 4:
            # Excerpts of a few words show how sure short texts can be.
            at, n = int(rng.integers(len(words))), int(rng.integers(1, 9))
            held += [whole, (features(words[at : at + n]), number[lang])]
    embed = rng.normal(0, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    weight = np.zeros((DIMENSIONS, len(languages)))
    bias = np.zeros(len(languages))
    # Rare languages count as much as frequent ones.
    share = np.bincount([y for _, y in fit], minlength=len(languages))
    balance = len(fit) / (len(languages) * np.maximum(share, 1))
    steps, step = epochs * len(fit), 0
    for _ in range(epochs):
        for i in rng.permutation(len(fit)):
            (buckets, part, _), y = fit[i]
            rate = RATE * (1 - step / steps) * min(balance[y], 10.0)
            mean = part @ embed[buckets]
            error = softmax(mean @ weight + bias)
            error[y] -= 1
            back = weight @ error
            weight -= rate * np.outer(mean, error)
            bias -= 0.1 * rate * error
            # The mean hands each subword its share only; scaled up, so that embeddings move as fast as weights.
            embed[buckets] -= rate * np.outer(np.minimum(part * 50, 1), back)
            step += 1
    model = Model(languages, (embed @ weight).astype(np.float32), bias)
    _calibrate(model, held)
    return model


def _calibrate(model: Model, held: list) -> None:
    """Sets temperature and doubt by likelihood, then the threshold by the error among what is accepted.

    ``held`` has whole texts and excerpts in turn.
    """
    truth = np.array([y for _, y in held])
    mean = np.array([part @ model.scores[buckets] for (buckets, part, _), _ in held])
    n = np.array([[k] for (_, _, k), _ in held], float)
    best = np.inf
    for t in np.geomspace(0.1, 20, 40):
        for doubt in (0.0, 5.0, 10.0, 20.0, 40.0, 80.0, 160.0):
            chances = softmax((mean + model.bias) * (n / (n + doubt)) / t)
            loss = -np.log(np.maximum(chances[np.arange(len(truth)), truth], 1e-12)).mean()
            if loss < best:
                best, model.temperature, model.doubt = loss, float(t), doubt
    chances = softmax(model.logits(mean, n))
    score, right = chances.max(axis=1), chances.argmax(axis=1) == truth
    at = 0.0
    for at in np.concatenate(([0.0], np.sort(score))):
        taken = score >= at
        if (~right & taken).sum() <= TARGET_ERROR * max(taken.sum(), 1):
            break
    # Clean texts come first: never a threshold that costs more than a few right answers on whole texts.
    whole = score[::2][right[::2]]
    most = np.quantile(whole, MAX_REJECTED, method="lower") if len(whole) else 0.0
    model.threshold = float(min(at, most))


# ---- the sample -------------------------------------------------------------


def may_learn(doc_id: Column) -> Column:
    """Rows whose crc32 of the id as text leaves another rest than 2 when divided by 4."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2


def fit(docs: DataFrame, learn: Column | None = None, per_language: int = SAMPLE_PER_LANGUAGE, seed: int = 42) -> Model:
    """Trains on about ``per_language`` rows of each language.

    ``learn`` says which rows may be used (default: all). Rows are picked by a
    hash of the id, so a rerun picks the same; null text or lang is never used.
    """
    usable = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    if learn is not None:
        usable = usable.where(learn)
    usable = usable.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    # A row per language; sent to all tasks if few, so that whole texts are not dealt out by language.
    share = cut(usable.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(per_language) / F.count("*")).alias("share")))
    share = F.broadcast(share) if share.count() <= FEW_LANGUAGES else share
    dice = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    # Bounded by languages x rows per language, whatever the table.
    sample = usable.join(share, "lang").where(dice < F.col("share")).select("text", "lang").collect()
    return train([(r["text"], r["lang"]) for r in sample], seed)


# ---- prediction -------------------------------------------------------------


class Scorer:
    """Scores whole texts; sums of known words are looked up. The older half of the words goes when there are too many."""

    def __init__(self, model: Model, remembered: int | None = None) -> None:
        self.model = model
        width = len(model.languages) + 1
        self.most = remembered or max(1, min(REMEMBERED, REMEMBERED_BYTES // (8 * width)))
        self.number: dict[str, int] = {}
        self.sums = np.zeros((1024, width))
        self.old_number: dict[str, int] = {}
        self.old_sums = np.zeros((0, width))

    def _learn(self, words: list[str]) -> None:
        first = len(self.number)
        while first + len(words) > len(self.sums):
            self.sums = np.concatenate((self.sums, np.zeros_like(self.sums)))
        known = [w for w in words if w in self.old_number]
        new = [w for w in words if w not in self.old_number]
        middle = first + len(known)
        self.sums[first:middle] = self.old_sums[[self.old_number[w] for w in known]]
        if new:
            codes, counts = subwords(new)
            rows = self.sums[middle : middle + len(new)]
            starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
            rows[:, :-1] = np.add.reduceat(self.model.scores[codes].astype(np.float64), starts)
            rows[:, -1] = counts
        self.number.update(zip(known + new, range(first, first + len(words)), strict=True))

    def score(self, text: str | None) -> tuple[str, float]:
        return self.score_all([text])[0]

    def score_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score) of each text; words new to the worker are learned for all of them at once."""
        if not self.model.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        words = [words_of(t) for t in texts]
        met = dict.fromkeys(chain.from_iterable(words))
        new = [w for w in met if w not in self.number]
        if self.number and len(self.number) + len(new) > self.most:
            self.old_number, self.old_sums = self.number, self.sums
            self.number, self.sums = {}, np.zeros_like(self.sums[:1024])
            new = list(met)
        if new:
            self._learn(new)
        return [self._answer(own) for own in words]

    def _answer(self, words: list[str]) -> tuple[str, float]:
        if not words:
            return UNKNOWN, 0.0
        total = self.sums[list(map(self.number.__getitem__, words))].sum(axis=0)
        chances = softmax(self.model.logits(total[:-1] / total[-1], total[-1]))
        best = int(chances.argmax())
        return self.model.languages[best], float(chances[best])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, rejected), one row per row of ``docs``.

    Only the text decides. Null texts and texts without a letter are ``und`` with
    score 0 and rejected; others have the best language and its calibrated
    probability, and are rejected below the model's threshold. Repeated rows get
    equal answers, null ids are kept; other columns are not read.
    """

    def make(schema: pa.Schema):
        def run(batches: Iterator[pa.RecordBatch]):
            scorer = Scorer(model)
            for batch in batches:
                found = scorer.score_all(batch.column("text").to_pylist())
                yield batch_of(
                    schema,
                    {"doc_id": batch.column("doc_id"), "lang_pred": [x for x, _ in found], "score": [x for _, x in found],
                     "rejected": [x == UNKNOWN or s < model.threshold for x, s in found]},
                )

        return run

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(texts, make, "doc_id long, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` with all their columns whose text is not rejected."""
    bound_batches(docs.sparkSession)
    spec = docs.schema

    def run(batches: Iterator[pa.RecordBatch]):
        scorer = Scorer(model)
        for batch in batches:
            found = scorer.score_all(batch.column("text").to_pylist())
            keep = pa.array([x != UNKNOWN and s >= model.threshold for x, s in found], pa.bool_())
            yield batch.filter(keep)

    return docs.mapInArrow(run, spec)
