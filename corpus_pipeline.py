"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from themewell.llm import grace, language, mixing, packing, simhash, tokens
from themewell.session import ensure_checkpoint_dir

SHINGLE_WORDS = 3
RADIUS = 3  # bits in which fingerprints of near copies may differ


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not recognised go, with them those whose text is null or has no letter.

    Repeated rows share one answer, very long texts are read whole, an empty
    table stays empty, and a table without labelled rows loses every row.
    """
    model = language.fit(docs, language.may_learn(F.col("doc_id")))
    return language.keep_identified(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays; a null text is an empty one.

    Rows that repeat id and text are one document: one of them stays. A row
    without id stays if no row with its text has one. Empty in, empty out.
    """
    # One key of text and id, for the join and for repeated rows alike: the texts are dealt out once.
    named = lambda sha: F.concat_ws("|", sha, F.coalesce(F.col("doc_id").cast("string"), F.lit("none")))
    key, kept = _free(docs, "_key"), _free(docs, "_kept")
    staying = grace.deduplicate(docs).where("kept").select(named(F.col("text_sha256")).alias(kept))
    sha = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    joined = docs.withColumn(key, named(sha)).join(staying, F.col(key) == F.col(kept), "left_semi")
    return joined.dropDuplicates([key]).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by fingerprints the document with the least doc_id stays.

    Rows without id stay, rows that share an id go together, null and empty texts
    are one group. Empty in, empty out.
    """
    found = simhash.near_duplicates(docs, width=SHINGLE_WORDS, radius=RADIUS, segments=2, ball=1)
    name = _free(docs, "_gone")
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares; documents taken twice are two rows, shard by shard in random order.

    Documents without words go, a null source is one of its own, of repeated rows
    each takes its share. Empty in, empty out.
    """
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in windows of 256 to 4096; a null or empty text is its end id, repeated rows are packed each. Empty in, empty out."""
    return packing.pack(docs, tokens.word_vocabulary())


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: Language model, fingerprints and tokens have no SQL form; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}_{name}"
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
