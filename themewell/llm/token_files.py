"""Files of token ids: ids by rank of frequency, coded in whole bytes, control bytes apart from the data.

A file is a run of blocks. All numbers are little-endian.

    magic        4 bytes  b"TWF1"
    bytes        u32      of the rest of the block, without the line feed
    shard, block u32 u32  place of the block in the whole: shards, then blocks, ascend with doc_id
    n_docs, n_ids u32 u32
    null bits    ceil(n_docs / 8) bytes, 1 where the document has no id
    doc_ids      n_docs x i64
    counts       n_docs x u32, ids of each document
    control      ceil(n_ids / 4) bytes: 2 bits an id, lowest first, its length in bytes less 1
    data         the ranks, 1 to 4 bytes each
    line feed    1 byte

``ranks`` beside the shards holds the ids in order of frequency, as one block of
its own. Ranks are as small as the ids are frequent, so most take one byte.
Decoding looks up the four lengths of each control byte in a table and gathers
all ranks at once.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from themewell.llm import tokens
from themewell.llm.arrow import batch_of, map_batches, partition_id, texts_of
from themewell.session import cut, ensure_checkpoint_dir

MAGIC = b"TWF1"
BLOCK_IDS = 1 << 19  # a block is closed beyond this many ids

_HEAD = "<4sIIIII"
_HEAD_BYTES = struct.calcsize(_HEAD)
#: Lengths of the four ids of a control byte.
_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


# ---- the code ---------------------------------------------------------------


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of unsigned 32-bit ranks."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[: len(ranks)] = extra
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    wide = ranks.view(np.uint8).reshape(-1, 4)
    return control.tobytes(), wide[np.arange(4) <= extra[:, None]].tobytes()


def decode_ranks(control: bytes | memoryview, data: bytes | memoryview, n: int) -> np.ndarray:
    """The ranks back, by table lookup of the lengths."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    ends = np.cumsum(lengths, dtype=np.int64)
    if (ends[-1] if n else 0) != len(data):
        raise ValueError("control and data do not fit")
    raw = np.frombuffer(data, np.uint8)
    starts = ends - lengths
    out = raw[starts].astype("<u4")
    for k in range(1, 4):
        at = np.flatnonzero(lengths > k)
        if not len(at):
            break
        out[at] |= raw[starts[at] + k].astype("<u4") << np.uint32(8 * k)
    return out


def pack_block(shard: int, block: int, doc_ids: list[int | None], counts: np.ndarray, ranks: np.ndarray) -> bytes:
    control, data = encode_ranks(ranks)
    nulls = np.packbits(np.array([d is None for d in doc_ids], np.uint8), bitorder="little").tobytes()
    ids = np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes()
    body = b"".join((nulls, ids, np.asarray(counts, "<u4").tobytes(), control, data))
    size = _HEAD_BYTES - 8 + len(body)
    return struct.pack(_HEAD, MAGIC, size, shard, block, len(doc_ids), len(ranks)) + body


def unpack_blocks(content: bytes) -> Iterator[tuple[int, int, list[int | None], np.ndarray, np.ndarray]]:
    """(shard, block, doc_ids, counts, ranks) of each block of a file."""
    at, view = 0, memoryview(content)
    while at < len(content):
        magic, size, shard, block, n_docs, n_ids = struct.unpack_from(_HEAD, content, at)
        end = at + 8 + size
        if magic != MAGIC or content[end : end + 1] != b"\n":
            raise ValueError("not a block of token ids")
        at += _HEAD_BYTES
        cuts = np.cumsum([at, -(-n_docs // 8), 8 * n_docs, 4 * n_docs, -(-n_ids // 4)])
        nulls = np.unpackbits(np.frombuffer(view[cuts[0] : cuts[1]], np.uint8), bitorder="little")[:n_docs]
        ids = np.frombuffer(view[cuts[1] : cuts[2]], "<i8").tolist()
        doc_ids = [None if gone else d for gone, d in zip(nulls, ids, strict=True)]
        counts = np.frombuffer(view[cuts[2] : cuts[3]], "<u4")
        yield shard, block, doc_ids, counts, decode_ranks(view[cuts[3] : cuts[4]], view[cuts[4] : end], n_ids)
        at = end + 1


# ---- writing and reading ----------------------------------------------------


#: Either a lot of documents, or (n_of_id) how often the task has met each id.
_LOTS = "shard int, block int, nulls binary, doc_ids binary, counts binary, ids binary, n_of_id binary"


def _tokenized(docs: DataFrame, path: str, spaced: bool, end_id: int, block_ids: int) -> DataFrame:
    """Lots of documents with their ids, one or more per range of doc_id, and a row of counts per task."""
    narrow = "<u2" if tokens.largest_id(path) < 1 << 16 and end_id < 1 << 16 else "<u4"

    def make(schema: pa.Schema):
        def row(shard, **values):
            return batch_of(schema, {"shard": [shard]} | {f: [values.get(f)] for f in schema.names[1:]})

        def lot(shard, block, doc_ids, parts, ids):
            counts = np.array([len(p) for p in parts], "<u4")
            nulls = np.array([d is None for d in doc_ids], np.uint8)
            known = np.array([0 if d is None else d for d in doc_ids], "<i8")
            return row(shard, block=block, nulls=nulls.tobytes(), doc_ids=known.tobytes(), counts=counts.tobytes(), ids=ids.tobytes())

        def run(batches: Iterator[pa.RecordBatch]):
            encode = tokens.encoder(path, spaced).encode_all
            end = np.array([end_id], "<u4")
            seen = np.zeros(1 << 16, np.int64)
            shard, block, doc_ids, parts, held = partition_id(), 0, [], [], 0

            def close():
                nonlocal seen, block, doc_ids, parts, held
                ids = np.concatenate(parts).astype(narrow)
                found = np.bincount(ids, minlength=len(seen))
                found[: len(seen)] += seen
                out = lot(shard, block, doc_ids, parts, ids)
                seen, block, doc_ids, parts, held = found, block + 1, [], [], 0
                return out

            for batch in batches:
                texts = (text.as_py() for text in batch.column("text"))
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(texts), strict=True):
                    parts.append(np.concatenate((ids, end)))
                    doc_ids.append(doc_id)
                    held += len(ids) + 1
                    if held >= block_ids:
                        yield close()
            if parts:
                yield close()
            if block:
                yield row(shard, n_of_id=seen.astype("<i8").tobytes())

        return run

    texts = texts_of(docs)
    # Ties of repeated ids go by the text, so that reruns give the same files.
    ordered = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    return map_batches(ordered, make, _LOTS)


def _frequencies(counts: DataFrame) -> DataFrame:
    """(id, n): the counts of all tasks, added up."""

    def make(schema: pa.Schema):
        def run(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                for counts in batch.column("n_of_id"):
                    n = np.frombuffer(counts.as_py(), "<i8")
                    found = np.flatnonzero(n)
                    yield batch_of(schema, {"id": pa.array(found), "n": pa.array(n[found])})

        return run

    return map_batches(counts, make, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _coded(lots: DataFrame, ids_by_rank: np.ndarray) -> DataFrame:
    rank_of = np.zeros(int(ids_by_rank.max(initial=0)) + 1, "<u4")
    rank_of[ids_by_rank] = np.arange(len(ids_by_rank), dtype="<u4")

    def make(schema: pa.Schema):
        def run(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                for row in batch.to_pylist():
                    doc_ids = np.frombuffer(row["doc_ids"], "<i8").tolist()
                    doc_ids = [None if gone else d for gone, d in zip(row["nulls"], doc_ids, strict=True)]
                    counts = np.frombuffer(row["counts"], "<u4")
                    kind = "<u2" if 2 * int(counts.sum()) == len(row["ids"]) else "<u4"
                    ranks = rank_of[np.frombuffer(row["ids"], kind)]
                    block = pack_block(row["shard"], row["block"], doc_ids, counts, ranks)
                    yield batch_of(schema, {"shard": [row["shard"]], "block": [block]})

        return run

    return map_batches(lots, make, "shard int, block binary")


def write(
    docs: DataFrame,
    path: str,
    vocabulary: str | None = None,
    spaced: bool = True,
    end_id: int = tokens.END_ID,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Token files of all texts in ascending doc_id order under ``path`` (shard=<n>/, ranks/).

    A null or empty text has the end id alone, a null doc_id comes first, repeated
    ids keep a document each. An empty table gives a ``ranks`` file without ids.
    Other columns are not read. Texts are encoded once; the ranks are over all.
    """
    spark = docs.sparkSession
    lots = cut(_tokenized(docs, vocabulary or tokens.byte_vocabulary(), spaced, end_id, block_ids))
    # As many rows as the vocabulary has ids.
    counted = _frequencies(lots.where("n_of_id is not null").select("n_of_id")).collect()
    ranked = np.array([r["id"] for r in sorted(counted, key=lambda r: (-r["n"], r["id"]))], "<u4")
    # Spark's text files take bytes as they are and commit whole tasks; the line feed ends a block.
    coded = _coded(lots.where("n_of_id is null").drop("n_of_id"), ranked)
    coded.select("shard", F.col("block").cast("string").alias("value")).write.partitionBy("shard").text(f"{path}/ids")
    table = pack_block(0, 0, [0], np.array([len(ranked)]), ranked)
    row = spark.createDataFrame([(bytearray(table),)], "block binary")
    row.select(F.col("block").cast("string").alias("value")).coalesce(1).write.text(f"{path}/ranks")


def _decoded(spark: SparkSession, path: str, last: str, of: Callable[[np.ndarray], object]) -> DataFrame:
    """(shard, block, seq, doc_id, n_tokens) of all documents, and what ``of`` makes of their ids."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*")
    (table,) = (bytes(r["content"]) for r in files.load(f"{path}/ranks").select("content").collect())
    ids_by_rank = next(iter(unpack_blocks(table)))[4]
    name = last.split()[0]

    def make(schema: pa.Schema):
        def run(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                for content in batch.column("content"):
                    for shard, block, doc_ids, counts, ranks in unpack_blocks(content.as_py()):
                        ids, n = ids_by_rank[ranks], len(doc_ids)
                        ends = np.cumsum(counts, dtype=np.int64)
                        parts = [of(ids[e - c : e]) for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
                        yield batch_of(
                            schema,
                            {"shard": [shard] * n, "block": [block] * n, "seq": list(range(n)), "doc_id": doc_ids,
                             "n_tokens": counts.tolist(), name: parts},
                        )

        return run

    schema = f"shard int, block int, seq int, doc_id long, n_tokens long, {last}"
    if not ids_by_rank.size:  # the corpus was empty, and there is nothing to list
        return spark.createDataFrame([], schema)
    content = files.option("recursiveFileLookup", "true").load(f"{path}/ids").select("content")
    return map_batches(content, make, schema)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(shard, block, seq, doc_id, n_tokens, ids): all documents of the files; ids are unsigned 32-bit."""
    return _decoded(spark, path, "ids binary", lambda ids: ids.tobytes())


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of all documents, read back from the files."""
    rows = cut(_decoded(spark, path, "ids_crc32 long", lambda ids: zlib.crc32(ids.tobytes())))
    blocks = rows.groupBy("shard", "block").agg(F.sum("n_tokens").alias("n"))
    shards = blocks.groupBy("shard").agg(F.sum("n").alias("n"))
    total = lambda over: F.coalesce(F.sum("n").over(over), F.lit(0))
    # One row per shard: as many as the range partitioning made.
    shards = shards.select("shard", total(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)).alias("s"))
    blocks = blocks.select("shard", "block", total(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)).alias("b"))
    starts = blocks.join(shards, "shard").select("shard", "block", (F.col("s") + F.col("b")).alias("base"))
    inside = Window.partitionBy("shard", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    joined = rows.withColumn("local", local).join(starts, ["shard", "block"])
    return joined.select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/tokens-{uuid.uuid4().hex}"
