"""Packing of tokenized documents into windows of several lengths.

Documents are routed by length to tiers, each with its window size; what exceeds
the longest window fills whole windows first. Tiers are packed from the longest
to the shortest. A gap in a window is filled with the longest document of a
shorter tier that fits, again and again, and what is left with the beginning of
one more document, so that windows are full. Full windows are dealt out to step
groups of equal cost.

Each task packs its own documents as they come, a bounded number of tokens at a
time; what the last windows cannot hold goes on to the next lot. At the end of a
task the rest goes into windows of the shorter tiers, so at most one window per
task has padding.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themewell.llm import tokens
from themewell.llm.arrow import batch_of, map_batches, partition_id, texts_of

TIERS = (256, 512, 1024, 2048, 4096)
LOT_TOKENS = 2_000_000  # packed at a time: bounds memory, and is many windows
STEP_WINDOWS = 8  # longest windows' worth of tokens in a step group


@dataclass
class Piece:
    """Tokens [start, start + length) of a document."""

    doc: int
    start: int
    length: int


@dataclass
class Window:
    tier: int
    pieces: list[Piece] = field(default_factory=list)


class Packer:
    """Packs documents given by number and length; windows come out full until ``finish``."""

    def __init__(self, tiers: tuple[int, ...] = TIERS) -> None:
        self.tiers = tuple(sorted(tiers))
        self.waiting: list[tuple[int, int, int]] = []  # (length, doc, start), sorted
        self.left = 0  # tokens that wait

    def add(self, doc: int, length: int) -> list[Window]:
        """Routes a document; whole windows of the longest tier leave at once."""
        top = self.tiers[-1]
        whole = [Window(top, [Piece(doc, at, top)]) for at in range(0, length - top + 1, top)]
        rest = length - top * len(whole)
        if rest:
            bisect.insort(self.waiting, (rest, doc, length - rest))
            self.left += rest
        return whole

    def pack(self) -> list[Window]:
        """All windows that can be filled, longest tier first; the rest keeps waiting."""
        out = []
        for i in range(len(self.tiers) - 1, -1, -1):
            tier, below = self.tiers[i], self.tiers[i - 1] if i else 0
            # Documents of this tier are longer than the next shorter window.
            while self.waiting and self.waiting[-1][0] > below and self.left >= tier:
                out.append(self._fill(tier))
        return out

    def finish(self) -> list[Window]:
        """Windows for all that still waits: the longest that can be filled, then one with padding."""
        out = self.pack()
        for tier in reversed(self.tiers):
            while self.left >= tier:
                out.append(self._fill(tier))
        if self.waiting:
            tier = self.tiers[bisect.bisect_left(self.tiers, self.left)]
            out.append(Window(tier, [Piece(d, s, n) for n, d, s in reversed(self.waiting)]))
            self.waiting, self.left = [], 0
        return out

    def _fill(self, tier: int) -> Window:
        window, gap = Window(tier), tier
        while gap:
            at = bisect.bisect_right(self.waiting, (gap, 1 << 62, 1 << 62)) - 1
            if at >= 0:  # the longest that fits
                length, doc, start = self.waiting.pop(at)
            else:  # none fits: the beginning of the shortest one
                length, doc, start = self.waiting.pop(0)
                bisect.insort(self.waiting, (length - gap, doc, start + gap))
                length = gap
            window.pieces.append(Piece(doc, start, length))
            gap -= length
        self.left -= tier
        return window


def step_groups(windows: list[Window], tiers: tuple[int, ...] = TIERS, step_windows: int = STEP_WINDOWS) -> list[int]:
    """A step number for each window: steps hold about equal tokens and, within that, equal squares of lengths."""
    budget = tiers[-1] * step_windows
    steps = max(1, round(sum(w.tier for w in windows) / budget))
    load, cost = np.zeros(steps), np.zeros(steps)
    out = [0] * len(windows)
    for i in sorted(range(len(windows)), key=lambda i: -windows[i].tier):
        at = int(np.lexsort((cost, load))[0])
        out[i] = at
        load[at] += windows[i].tier
        cost[at] += float(windows[i].tier) ** 2
    return out


_PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, "
    "tier int, step_group long"
)


def pack(
    docs: DataFrame,
    vocabulary: str | None = None,
    spaced: bool = False,
    end_id: int = tokens.END_ID,
    tiers: tuple[int, ...] = TIERS,
    lot_tokens: int = LOT_TOKENS,
) -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset, tier, step_group).

    ``ids`` are little-endian unsigned 32-bit integers; each document ends with
    ``end_id``, which counts. ``offset`` is the place in the window ``sequence_id``,
    whose size is ``tier``. A null or empty text is the end id alone. Repeated rows
    are packed each; a null id is kept. An empty table gives an empty one, other
    columns are not read. Windows depend on how rows are dealt over partitions;
    a task that runs again gives the same windows.
    """
    path = vocabulary or tokens.word_vocabulary()

    def make(schema: pa.Schema):
        def rows(windows: list[Window], kept: dict, first: int) -> pa.RecordBatch:
            cols: dict[str, list] = {f.name: [] for f in schema}
            steps = step_groups(windows, tiers)
            for number, (window, step) in enumerate(zip(windows, steps, strict=True), first):
                offset = 0
                for p in window.pieces:
                    doc_id, ids = kept[p.doc]
                    row = (doc_id, p.start, p.length, ids[p.start : p.start + p.length].tobytes(), len(ids), number,
                           offset, window.tier, first + step)
                    for name, value in zip(cols, row, strict=True):
                        cols[name].append(value)
                    offset += p.length
            return batch_of(schema, cols)

        def run(batches: Iterator[pa.RecordBatch]):
            encode = tokens.encoder(path, spaced).encode_all
            end = np.array([end_id], "<u4")
            packer, kept, windows, held = Packer(tiers), {}, [], 0
            number, doc = partition_id() << 40, 0
            for batch in batches:
                texts = (text.as_py() for text in batch.column("text"))
                for doc_id, found in zip(batch.column("doc_id").to_pylist(), encode(texts), strict=True):
                    ids = np.concatenate((found, end))
                    kept[doc] = (doc_id, ids)
                    windows += packer.add(doc, len(ids))
                    held += len(ids)
                    doc += 1
                    if held >= lot_tokens:
                        windows += packer.pack()
                        yield rows(windows, kept, number)
                        number += len(windows)
                        waiting = {d for _, d, _ in packer.waiting}
                        kept = {d: kept[d] for d in waiting}
                        windows, held = [], packer.left
            windows += packer.finish()
            yield rows(windows, kept, number)

        return run

    return map_batches(texts_of(docs), make, _PIECES)


def with_checksums(pieces: DataFrame) -> DataFrame:
    """``ids_crc32`` (unsigned) in place of ``ids``."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")

