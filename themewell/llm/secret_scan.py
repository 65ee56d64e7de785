"""Secret scan: known forms, and a battery of randomness tests with false-discovery control.

Known forms are assignments to telling names, access keys and long hex runs.
Further long runs of code characters are candidates, and so are their parts between
slashes, dashes and the like, as keys stand in paths and URLs. A part is reported if
no longer candidate around it is. For each the encoding is inferred, and the symbols are tested for uniformity of the alphabet
(chi-squared), for runs above and below the middle of the alphabet and for serial
correlation; Fisher's method combines the three chances.

What ordinary text would score is measured on the same corpus: for each
candidate, decoys of its length are put together from the letters and digits of
its own document around it, and of other documents where it has too few. In each
class of lengths the mildest threshold is taken at which decoys, scaled by the
number that was made, are no more than a given share of the candidates. Only
counts by class and score leave the tasks for that.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themewell.llm.arrow import batch_of, map_batches, texts_of
from themewell.session import cut

KINDS = ("assign", "access", "hex", "random")
SHORTEST = 20  # characters of a candidate
DECOYS = 8  # per candidate, as far as there are words
SPARE = 1 << 18  # characters of words that a task keeps for texts with too few
RATE = 0.05  # false discoveries among what is reported beside the known forms
BINS = 64  # steps of the score, from chances of 1e-16 to 1
SPAN_LOT = 2000  # candidates whose decoys are held at a time
TOGETHER = 1 << 20  # characters that are tested at a time
LENGTHS = (20, 24, 32, 48, 64, 128)  # lower ends of the classes of lengths

_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
_NAMES = ("passw", "secret", "token", "api")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_=.-])[A-Za-z0-9+/_=.-]{16,}")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
#: Whole runs, and their parts between slashes, dashes and the like.
_CODES = [re.compile(rf"[A-Za-z0-9{signs}]{{{SHORTEST},}}={{0,2}}") for signs in ("+/_-", "")]
_PLAIN = re.compile(r"[A-Za-z0-9]+")

#: Alphabets in the order in which they are tried; symbols in the order of their values.
ENCODINGS = (
    ("hex", "0123456789abcdef"),
    ("hex", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
_ALPHABETS = [(name, frozenset(a)) for name, a in ENCODINGS]


def _table(alphabet: str) -> np.ndarray:
    out = np.full(256, -1, np.int16)
    out[np.frombuffer(alphabet.encode(), np.uint8)] = np.arange(len(alphabet))
    return out


_TABLES = [(len(a), _table(a)) for _, a in ENCODINGS]


# ---- known forms ------------------------------------------------------------


def known_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of kind, end) of assignments, access keys and hex runs, sorted."""
    out = []
    low = text.lower()
    if any(n in low for n in _NAMES):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    for run in _RUN.finditer(text):  # keys and hex of the wanted lengths lie within such runs
        word, at = run[0], run.start()
        if "AKIA" in word:
            out += [(at + m.start(), 1, at + m.end()) for m in _ACCESS.finditer(word) if len(m[0]) >= 16]
        if len(word) >= 32:
            out += [(at + m.start(), 2, at + m.end()) for m in _HEX.finditer(word) if len(m[0]) >= 32]
    return sorted(out)


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


# ---- tests of randomness ----------------------------------------------------


def infer(code: str) -> str | None:
    """The first encoding that has all characters."""
    body = set(code.rstrip("="))
    return next((name for name, alphabet in _ALPHABETS if body <= alphabet), None)


def _upper_normal(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _chances(zs: np.ndarray) -> np.ndarray:
    return np.array([_upper_normal(z) for z in zs])


def uniformity(values: np.ndarray, size: int) -> np.ndarray:
    """Chance of counts at least as uneven, by the cube-root approximation of chi-squared; values by rows."""
    values = np.atleast_2d(values)
    rows, n = values.shape
    free = size - 1
    counts = np.bincount((values + size * np.arange(rows)[:, None]).ravel(), minlength=rows * size).reshape(rows, size).astype(float)
    x = (counts * counts).sum(axis=1) * size / n - n
    spread = 2 / (9 * free)
    return _chances(((np.maximum(x, 1e-9) / free) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))


def runs(values: np.ndarray, size: int) -> np.ndarray:
    """Two-sided chance of the number of runs above and below the middle of the alphabet; values by rows."""
    high = np.atleast_2d(values) >= size / 2
    n = high.shape[1]
    n1 = high.sum(axis=1)
    n2 = n - n1
    seen = 1 + (high[:, 1:] != high[:, :-1]).sum(axis=1)
    mean = 1 + 2 * n1 * n2 / n
    var = (mean - 1) * (mean - 2) / max(1, n - 1)
    # All on one side is unlikely as such; half sides are what is expected.
    both = np.minimum(1.0, 2 * _chances(np.abs(seen - mean) / np.sqrt(np.maximum(var, 1e-9))))
    return np.where((n1 == 0) | (n2 == 0), 2.0 ** (1 - n), both)


def serial(values: np.ndarray, size: int) -> np.ndarray:
    """Two-sided chance of the correlation of neighbours; values by rows."""
    x = np.atleast_2d(values) - (size - 1) / 2
    n = x.shape[1]
    whole = (x * x).sum(axis=1)
    r = np.abs((x[:, 1:] * x[:, :-1]).sum(axis=1)) / np.where(whole == 0, 1, whole)
    return np.where((n < 3) | (whole == 0), 1.0, np.minimum(1.0, 2 * _chances(r * math.sqrt(n))))


def combined_all(codes: list[str]) -> list[float]:
    """For each code the chance that random symbols look at least as odd in all three tests (Fisher).

    0 for no encoding or digits only. Codes of one length are tested together.
    """
    out = [0.0] * len(codes)
    by_length: dict[int, list[int]] = {}
    bodies = [c.rstrip("=") for c in codes]
    for i, body in enumerate(bodies):
        if body and body.isascii() and not body.isdigit():
            by_length.setdefault(len(body), []).append(i)
    for n, group in by_length.items():
        step = max(1, TOGETHER // n)
        for at in range(0, len(group), step):
            rows = np.array(group[at : at + step])
            signs = np.frombuffer("".join(bodies[i] for i in rows).encode(), np.uint8).reshape(len(rows), n)
            for size, table in _TABLES:
                values = table[signs]
                fits = (values >= 0).all(axis=1)
                if fits.any():
                    half = np.zeros(int(fits.sum()))
                    for test in (uniformity, runs, serial):
                        half -= np.log(np.maximum(test(values[fits], size), 1e-300))
                    chance = np.minimum(1.0, np.exp(-half) * (1 + half + half * half / 2))  # chi-squared of 6 degrees
                    for i, p in zip(rows[fits].tolist(), chance.tolist(), strict=True):
                        out[i] = p
                    rows, signs = rows[~fits], signs[~fits]
                if not len(rows):
                    break
    return out


def combined(code: str) -> float:
    return combined_all([code])[0]


def score_bin(chance: float) -> int:
    """0 (no chance) to BINS - 1 (as random symbols are)."""
    return max(0, min(BINS - 1, int(BINS * (1 + math.log10(max(chance, 1e-16)) / 16))))


def length_class(n: int) -> int:
    return sum(n >= x for x in LENGTHS) - 1


class _Taken:
    """Spans merged into disjoint ones, so that an overlap is found by one search."""

    def __init__(self, spans: Iterable[tuple[int, int]]) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted(spans):
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def meets(self, start: int, end: int) -> bool:
        i = bisect_left(self.starts, end) - 1
        return i >= 0 and self.ends[i] > start


def candidates(text: str, known: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Runs of code characters beside the known spans that an alphabet holds, and the parts of all runs; parts lie in others."""
    out = set()
    taken = _Taken((s, e) for s, _, e in known)
    for run in _RUN.finditer(text):
        for m in (m for code in _CODES for m in code.finditer(run[0])):
            start, end = run.start() + m.start(), run.start() + m.end()
            if not taken.meets(start, end) and infer(m[0]) is not None:
                out.add((start, end))
    return sorted(out)


def wholes(found: list[tuple[int, int]]) -> list[int]:
    """For each candidate the number of the longer one around it, or -1. There is one at most: whole runs are disjoint."""
    out = [-1] * len(found)
    last = -1
    for i in sorted(range(len(found)), key=lambda i: (found[i][0], -found[i][1])):
        if last >= 0 and found[i][1] <= found[last][1]:
            out[i] = last
        else:
            last = i
    return out


class Words:
    """The short words of a text outside of the taken spans, joined, and the places where they begin; read once per text."""

    def __init__(self, text: str, taken: list[tuple[int, int]]) -> None:
        spans = _Taken(taken)
        words = [m for m in _PLAIN.finditer(text) if m.end() - m.start() < SHORTEST and not spans.meets(*m.span())]
        self.words = [m[0] for m in words]
        self.starts = [m.start() for m in words]
        self.before = [0, *accumulate(map(len, self.words))]
        self.joined = "".join(self.words)

    def around(self, at: int, need: int) -> str:
        """``need`` characters from the words from place ``at`` on, going round at the end of the text, or all there are."""
        first = self.before[bisect_left(self.starts, at)]
        out = self.joined[first : first + need]
        return out + self.joined[: min(first, need - len(out))]


def decoys(
    text: str, start: int, end: int, words: Words, count: int = DECOYS, others: Callable[[], str] = str
) -> list[str]:
    """Strings as long as the candidate, from the words of ``text`` outside of all spans, from different places.

    Slashes, dashes and the like stand where the candidate has them, so that paths are held against words in paths.
    Where these are too few, ``others()`` gives letters and digits of other texts.
    """
    need = end - start
    joined = words.around(end, need * count)
    if len(joined) < need * count and (more := others()):
        at = zlib.crc32(text[start:end].encode("utf-8", "surrogatepass")) % len(more)
        want = need * count - len(joined)
        joined += more[at : at + want]
        joined += more[: max(0, min(at, need * count - len(joined)))]
    signs = [(i, c) for i, c in enumerate(text[start:end]) if not c.isalnum()]
    out = []
    for at in range(0, min(count, len(joined) // need) * need, need):
        made = list(joined[at : at + need])
        for i, c in signs:
            made[i] = c
        out.append("".join(made))
    return out


class _Spare:
    """The different words of the texts of a batch and of earlier ones, joined; read when first asked for.

    Each word stands once: a few that come again and again would make decoys that no test takes for random.
    """

    def __init__(self) -> None:
        self.texts: pa.Array | None = None
        self.words: dict[str, None] = {}
        self.joined = ""

    def add(self, texts: pa.Array) -> None:
        self.texts = texts

    def __call__(self) -> str:
        if self.texts is not None:
            words, have = {}, 0
            for t in self.texts:
                text = t.as_py() or ""
                known = known_spans(text)
                taken = [(s, e) for s, _, e in known] + candidates(text, known)
                new = dict.fromkeys(w for w in Words(text, taken).words if w not in words)
                words |= new
                have += sum(map(len, new))
                if have >= SPARE:
                    break
            self.joined = "".join(words | self.words)[:SPARE]
            self.words = words
            self.texts = None
        return self.joined


# ---- the scan ---------------------------------------------------------------

_FOUND = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
    "base array<struct<start: int, kind: int, end: int>>, "
    "more array<struct<start: int, kind: int, end: int, class: int, bin: int, over_class: int, over_bin: int>>, decoys array<int>"
)


def _scanned(docs: DataFrame) -> DataFrame:
    def make(schema: pa.Schema):
        def one(doc_id, text, spare):
            known = known_spans(text)
            found = candidates(text, known)
            taken = [(s, e) for s, _, e in known] + found
            kinds = [length_class(end - start) for start, end in found]
            bins = [score_bin(p) for p in combined_all([text[s:e] for s, e in found])]
            more, odd = [], []
            for i, of in enumerate(wholes(found)):
                over = (kinds[of], bins[of]) if of >= 0 else (0, -1)
                start, end = found[i]
                more.append({"start": start, "kind": 3, "end": end, "class": kinds[i], "bin": bins[i], "over_class": over[0], "over_bin": over[1]})
            words = Words(text, taken) if found else None
            for at in range(0, len(found), SPAN_LOT):
                made = [(kinds[i], d) for i in range(at, min(at + SPAN_LOT, len(found))) for d in decoys(text, *found[i], words, others=spare)]
                odd += [kind * BINS + score_bin(p) for (kind, _), p in zip(made, combined_all([d for _, d in made]), strict=True)]
            counts = [sum(k == i for _, k, _ in known) for i in range(3)]
            digest = hashlib.sha256(shown(known).encode()).hexdigest()
            base = [{"start": s, "kind": k, "end": e} for s, k, e in known]
            return doc_id, *counts, digest, base, more, odd

        def run(batches: Iterator[pa.RecordBatch]):
            spare = _Spare()
            for batch in batches:
                texts = batch.column("text")
                spare.add(texts)
                rows = [one(i, t.as_py() or "", spare) for i, t in zip(batch.column("doc_id").to_pylist(), texts, strict=True)]
                yield batch_of(schema, {f.name: [r[k] for r in rows] for k, f in enumerate(schema)})

        return run

    return map_batches(texts_of(docs), make, _FOUND)


def thresholds(targets: dict[tuple[int, int], int], false: dict[tuple[int, int], int], rate: float = RATE) -> list[int]:
    """Least bin to report for each class of lengths (BINS: none).

    Decoys at or above a bin and one more to be safe, times the candidates for each
    decoy that was made, estimate the false candidates there. Without decoys
    nothing is reported, and the lowest bin, where no test ran or all failed, never is.
    """
    out = []
    for kind in range(len(LENGTHS)):
        best, t, f = BINS, 0, 0
        total, made = (sum(n for (k, _), n in x.items() if k == kind) for x in (targets, false))
        for b in range(BINS - 1, 0, -1):
            t += targets.get((kind, b), 0)
            f += false.get((kind, b), 0)
            if t and made and (f + 1) * total / made <= rate * t:
                best = b
        out.append(best)
    return out


def scan(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random), one row per row of ``docs``.

    Spans are ``kind:start:end`` in code points, end exclusive, by start, then
    kind, joined by commas; ``base_sha256`` is over those of the known forms.
    ``rate`` bounds the share of false ones among the added spans of each class of
    lengths; with few candidates, or few words to make decoys of, none may be added. Null and empty texts have no
    spans, repeated rows equal ones, null ids are kept; other columns are not read.
    """
    found = cut(_scanned(docs))
    # At most classes x bins rows each.
    bins = found.select(F.explode("more").alias("m")).groupBy("m.class", "m.bin").count()
    targets = {(r["class"], r["bin"]): r["count"] for r in bins.collect()}
    odd = found.select(F.explode("decoys").alias("d")).groupBy("d").count().collect()
    false = {divmod(r["d"], BINS): r["count"] for r in odd}
    least = F.array(*[F.lit(b) for b in thresholds(targets, false, rate)])
    passed = F.filter("more", lambda m: m["bin"] >= least[m["class"]])
    taken = F.filter(passed, lambda m: m["over_bin"] < least[m["over_class"]])  # none longer around it is reported
    plain = F.transform(taken, lambda m: F.struct(m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end")))
    names = F.array(*[F.lit(k) for k in KINDS])
    spans = F.transform(
        F.array_sort(F.concat("base", plain)), lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))
    )
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
        F.array_join(spans, ",").alias("spans"),
        F.size(taken).cast("long").alias("n_random"),
    )
