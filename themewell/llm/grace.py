"""Exact deduplication by Grace hash partitioning.

Each task first collapses the copies it meets itself, in an open-addressing
table that compares complete contents, and spills one record per content and
task to the shared folder. Spilled records are partitioned by leading bits of
their hash; a bucket whose different contents exceed the budget is partitioned
again by further bits into new spill files, until each fits. Then one table per
bucket finds equal contents. Copies never travel as text more than once per
task, and what a group's rows need to know comes back on the record of their
own task, so that a text with a third of all rows is no hot key.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themewell.llm.arrow import batch_of, map_batches, partition_id, texts_of
from themewell.session import cut

BUDGET = 64 << 20  # bytes of one table: different contents, and what each entry and record takes beside them
ENTRY = 400  # bytes of an entry beside its content: slot, hash, objects, counts, answer; measured
RECORD = 120  # bytes of a record in the lists of its bucket
STEP_BITS = 4


class ContentTable:
    """Open addressing with linear probing; equal means equal bytes, whatever the hash."""

    def __init__(self, slots: int = 1024) -> None:
        self.slots = [-1] * slots
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def add(self, code: int, content: bytes) -> tuple[int, bool]:
        """Number of the content, and whether it is new."""
        mask = len(self.slots) - 1
        at = code & mask
        while (i := self.slots[at]) >= 0:
            if self.hashes[i] == code and self.contents[i] == content:
                return i, False
            at = (at + 1) & mask
        i = len(self.contents)
        self.slots[at] = i
        self.hashes.append(code)
        self.contents.append(content)
        self.bytes += len(content) + ENTRY
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return i, True

    def _grow(self) -> None:
        self.slots = [-1] * (4 * len(self.slots))
        mask = len(self.slots) - 1
        for i, code in enumerate(self.hashes):
            at = code & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = i


def _later(x: tuple, y: tuple) -> tuple:
    """The (doc_id, row) that stays: largest id, null least, then the later row."""
    key = lambda p: (p[0] is not None, p[0] or 0, p[1])
    return x if key(x) >= key(y) else y


_SPILL = "head boolean, row long, rid long, doc_id long, code long, bytes long, content binary, n long, last_row long"


def _spill(docs: DataFrame, budget: int, hash64) -> DataFrame:
    """Rows of two kinds: for each document its record ``rid``, and each record (``head``) with its content.

    Numbers of rows come from the partition and the place in it, so a task that
    runs again gives the same rows.
    """

    def make(schema: pa.Schema):
        def heads(table, rids, counts, last):
            k = len(rids)
            codes = [c - (1 << 64) if c >> 63 else c for c in table.hashes]
            return batch_of(
                schema,
                {"head": [True] * k, "row": [None] * k, "rid": rids, "doc_id": [x[0] for x in last], "code": codes,
                 "bytes": [len(c) for c in table.contents], "content": table.contents, "n": counts,
                 "last_row": [x[1] for x in last]},
            )

        def run(batches: Iterator[pa.RecordBatch]):
            row = partition_id() << 40
            table, rids, counts, last = ContentTable(), [], [], []
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                texts = batch.column("text").cast(pa.binary()).to_pylist()
                own = []
                for doc_id, text in zip(ids, texts, strict=True):
                    text = text or b""
                    i, new = table.add(hash64(text), text)
                    if new:
                        rids.append(row)
                        counts.append(1)
                        last.append((doc_id, row))
                    else:
                        counts[i] += 1
                        last[i] = _later((doc_id, row), last[i])
                    own.append(rids[i])
                    row += 1
                k = len(own)
                none = [None] * k
                yield batch_of(
                    schema,
                    {"head": [False] * k, "row": list(range(row - k, row)), "rid": own, "doc_id": ids, "code": none,
                     "bytes": none, "content": none, "n": none, "last_row": none},
                )
                if table.bytes > budget:
                    yield heads(table, rids, counts, last)
                    table, rids, counts, last = ContentTable(), [], [], []
            yield heads(table, rids, counts, last)

        return run

    return map_batches(docs, make, _SPILL)


def _resolve(records: DataFrame) -> DataFrame:
    """For each record its group's (keep_id, group_size, keep_row, sha256); a task holds one bucket's table."""

    def make(schema: pa.Schema):
        def flush(table, rids, groups, counts, last):
            shas = [hashlib.sha256(c).hexdigest() for c in table.contents]
            return batch_of(
                schema,
                {"rid": rids, "keep_id": [last[g][0] for g in groups], "group_size": [counts[g] for g in groups],
                 "keep_row": [last[g][1] for g in groups], "text_sha256": [shas[g] for g in groups]},
            )

        def run(batches: Iterator[pa.RecordBatch]):
            now, table, rids, groups, counts, last = None, ContentTable(), [], [], [], []
            for batch in batches:
                columns = ("bucket", "rid", "code", "n", "doc_id", "last_row")
                rows = zip(*(batch.column(c).to_pylist() for c in columns), strict=True)
                contents = batch.column("content")
                for at, (bucket, rid, code, n, doc_id, last_row) in enumerate(rows):
                    if bucket != now:
                        yield flush(table, rids, groups, counts, last)
                        now, table, rids, groups, counts, last = bucket, ContentTable(), [], [], [], []
                    g, new = table.add(code & 0xFFFFFFFFFFFFFFFF, contents[at].as_py())
                    if new:
                        counts.append(n)
                        last.append((doc_id, last_row))
                    else:
                        counts[g] += n
                        last[g] = _later((doc_id, last_row), last[g])
                    rids.append(rid)
                    groups.append(g)
            yield flush(table, rids, groups, counts, last)

        return run

    dealt = records.repartition("bucket").sortWithinPartitions("bucket")
    return map_batches(dealt, make, "rid long, keep_id long, group_size long, keep_row long, text_sha256 string")


def _bucketed(records: DataFrame, bits: int) -> DataFrame:
    bucket = F.shiftrightunsigned("code", 64 - bits) if bits else F.lit(0)
    return records.withColumn("bucket", bucket.cast("long"))


def deduplicate(docs: DataFrame, budget: int = BUDGET, hash64=xxhash.xxh64_intdigest) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``.

    Texts are equal if all their bytes are; null counts as empty. The row with
    the largest doc_id stays. Of rows that repeat id and text exactly one stays
    (the last as read), and a row without id stays only in a group without any id.
    Empty in, empty out; other columns are not read. ``hash64`` only deals the
    records out: equal codes of different contents are told apart.
    """
    spilled = cut(_spill(texts_of(docs), budget, hash64))
    records = spilled.where("head").drop("head", "row")
    total = records.agg(F.sum(F.col("bytes") + ENTRY + RECORD)).head()[0] or 0
    bits = min(48, max(0, math.ceil(math.log2(max(1.0, 4 * total / budget)))))
    done = []
    while True:
        records = _bucketed(records, bits)
        held = F.max("bytes") + F.lit(ENTRY) + F.count("*") * RECORD
        contents = records.groupBy("bucket", "code").agg(held.alias("bytes"))
        sizes = contents.groupBy("bucket").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("codes"))
        # A single code cannot be parted further; its table holds each different content once anyway.
        large = cut(sizes.where((F.col("bytes") > budget) & (F.col("codes") > 1)).select("bucket"))
        if bits >= 64 or large.isEmpty():
            done.append(_resolve(records))
            break
        done.append(_resolve(records.join(large, "bucket", "left_anti")))
        records = cut(records.join(large, "bucket", "left_semi").drop("bucket"))
        bits = min(64, bits + STEP_BITS)
    groups = done[0]
    for more in done[1:]:
        groups = groups.unionByName(more)
    rows = spilled.where(~F.col("head")).select("row", "rid", "doc_id")
    return rows.join(groups, "rid").select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256"
    )
