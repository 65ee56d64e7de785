"""Registered queries of the operators, with production settings, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from themewell.llm import (
    grace,
    language,
    merkle,
    metric_join,
    mixing,
    packing,
    page_text,
    pseudonyms,
    secret_scan,
    shards,
    simhash,
    spelling,
    token_files,
    tokens,
)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Pseudonyms of the registered query are linked by this key; users bring their own.
_QUERY_KEY = b"key of the registered query only"


def op1_randomness_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_documents(spark, sf_dir))


def op2_metric_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_join.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), least_cosine=0.93)


def op3_splitting_tree_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _ = mixing.plan(_documents(spark, sf_dir))
    return documents


def op4_ranked_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.scratch(spark)
    token_files.write(_documents(spark, sf_dir), path, tokens.byte_vocabulary())
    return token_files.digests(spark, path)


def op5_subword_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    may_learn = language.may_learn(F.col("doc_id"))
    model = language.fit(docs, may_learn)
    found = language.identify(docs, model)
    held_out = F.coalesce(~language.may_learn(F.col("doc_id")), F.lit(False))  # a row without id has no remainder
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op6_tiered_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_documents(spark, sf_dir), tokens.word_vocabulary())
    return packing.with_checksums(pieces)


def op7_byte_prefix_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign(_documents(spark, sf_dir), shards=24)


def op8_grace_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grace.deduplicate(_documents(spark, sf_dir))


def op9_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymize(_documents(spark, sf_dir), _QUERY_KEY)


def op10_simhash_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_documents(spark, sf_dir), width=3, radius=3, segments=2, ball=1)
    return found.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def op11_merkle_climb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_documents(spark, sf_dir), merkle.every_fifth(F.col("doc_id")))


def op12_nearest_url_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op13_partenum_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_randomness_battery": op1_randomness_battery,
        "op2_metric_range_join": op2_metric_range_join,
        "op3_splitting_tree_mix": op3_splitting_tree_mix,
        "op4_ranked_token_files": op4_ranked_token_files,
        "op5_subword_language_id": op5_subword_language_id,
        "op6_tiered_packing": op6_tiered_packing,
        "op7_byte_prefix_shards": op7_byte_prefix_shards,
        "op8_grace_dedup": op8_grace_dedup,
        "op9_feistel_pseudonyms": op9_feistel_pseudonyms,
        "op10_simhash_multi_index": op10_simhash_multi_index,
        "op11_merkle_climb": op11_merkle_climb,
        "op12_nearest_url_text": op12_nearest_url_text,
        "op13_partenum_spellings": op13_partenum_spellings,
        "pipeline": corpus_pipeline.run,
    }


_OP2 = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id, b.vec_id AS other FROM usable a JOIN usable b
  ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93
), reached AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION
  SELECT reached.vec_id, links.other FROM reached JOIN links ON links.vec_id = reached.other
)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.vec_id = reached.vec_id) AS n_links,
  min(other) AS component_id, vec_id = min(other) AS kept
FROM reached GROUP BY vec_id
"""

#: CRC-32 by its public table: 8 steps of the reflected polynomial 0xEDB88320 for each of 256 bytes.
_OP7 = """
WITH crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda acc, k:
    CASE WHEN acc % 2 = 1 THEN xor(acc // 2, 3988292384) ELSE acc // 2 END, b)) AS t
), sized AS (
  SELECT doc_id, coalesce(strlen(text), 0) + 8 AS size,
    CASE WHEN text IS NULL THEN NULL ELSE xor(list_reduce(
      list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::BIGINT),
      lambda acc, b: xor(acc // 256, t[xor(acc % 256, b) + 1]), 4294967295::BIGINT), 4294967295) END AS text_crc32
  FROM documents, crc_table
), placed AS (
  SELECT *, coalesce(sum(size) OVER before, 0) AS before_size, sum(size) OVER () AS total
  FROM sized WINDOW before AS (ORDER BY doc_id NULLS FIRST, size, text_crc32 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), cut AS (
  SELECT *, least(((2 * before_size + size) * 24 // (2 * total))::INTEGER, 23) AS shard FROM placed
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
  NULL::INTEGER AS grown_shard
FROM cut
"""

_OP8 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

_OP11 = """
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda acc, k:
    CASE WHEN acc % 2 = 1 THEN xor(acc // 2, 3988292384) ELSE acc // 2 END, b)) AS t
), rows AS (
  SELECT *, CASE WHEN xor(list_reduce(list_transform(regexp_extract_all(hex(encode(doc_id::VARCHAR)), '..'), lambda h: ('0x' || h)::BIGINT),
      lambda acc, b: xor(acc // 256, t[xor(acc % 256, b) + 1]), 4294967295::BIGINT), 4294967295) % 5 = 0
    THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS other
  FROM documents, crc_table
), fields AS (
  SELECT doc_id, source, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS facts,
    coalesce(strlen(text) || ':' || text, '-') AS text, coalesce(strlen(other) || ':' || other, '-') AS other
  FROM rows
), hashed AS (
  SELECT doc_id, source, sha256(facts || text) AS leaf, sha256(facts || other) AS other FROM fields
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s
  FROM hashed
), levels AS (
  SELECT s, 0 AS level, i, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT s, level + 1, i // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY i)) FROM levels
  WHERE n > 1 GROUP BY s, level, i // 16, n
), subroots AS (
  SELECT s, digest FROM levels WHERE n = 1
), tops AS (
  SELECT 0 AS level, s AS i, (SELECT count(*) FROM subroots) AS n, digest FROM subroots
  UNION ALL
  SELECT level + 1, i // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY i)) FROM tops
  WHERE n > 1 GROUP BY level, i // 16, n
), nodes AS (
  SELECT s, level, i, n, digest, false AS top FROM levels UNION ALL SELECT -1, level, i, n, digest, true FROM tops
), siblings AS (
  SELECT a.s, a.level, a.i, a.top, coalesce(string_agg(b.digest, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before,
    coalesce(string_agg(b.digest, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS after
  FROM nodes a JOIN nodes b ON a.s = b.s AND a.level = b.level AND a.i // 16 = b.i // 16 WHERE a.n > 1 GROUP BY a.s, a.level, a.i, a.top
), climb AS (
  SELECT doc_id, leaf, s AS source, s, 0 AS level, i, n, false AS top, other AS folded, '' AS proof FROM leaves
  UNION ALL
  SELECT doc_id, leaf, source, CASE WHEN c.n > 1 THEN c.s ELSE -1 END, CASE WHEN c.n > 1 THEN c.level + 1 ELSE 0 END,
    CASE WHEN c.n > 1 THEN c.i // 16 ELSE source END, CASE WHEN c.n > 1 THEN (c.n + 15) // 16 ELSE (SELECT count(*) FROM subroots) END,
    c.top OR c.n = 1, CASE WHEN c.n > 1 THEN sha256(before || folded || after) ELSE folded END, proof || coalesce(before || after, '')
  FROM climb c LEFT JOIN siblings x ON c.s = x.s AND c.level = x.level AND c.i = x.i AND c.n > 1
  WHERE NOT (c.top AND c.n = 1)
)
SELECT doc_id, leaf, (SELECT digest FROM subroots WHERE subroots.s = climb.source) AS subroot,
  (SELECT digest FROM tops WHERE n = 1) AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
  folded = (SELECT digest FROM tops WHERE n = 1) AS verified
FROM climb WHERE top AND n = 1
"""

_OP13 = """
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda acc, k:
    CASE WHEN acc % 2 = 1 THEN xor(acc // 2, 3988292384) ELSE acc // 2 END, b)) AS t
), found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents
), runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS name, run, count(*) AS n FROM found GROUP BY doc_id, run
), hashed AS (
  SELECT run, n, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(name)), '..'), lambda h: ('0x' || h)::BIGINT),
      lambda acc, b: xor(acc // 256, t[xor(acc % 256, b) + 1]), 4294967295::BIGINT), 4294967295) AS h
  FROM runs, crc_table
), written AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM written WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), holes AS (
  SELECT word, n, i, left(word, (i - 1)::INT) || substr(word, i + 1) AS rest FROM words, generate_series(1, length(word)) AS g(i)
), edits AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM holes a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, a.word, a.n FROM holes a JOIN words b ON a.rest = b.word
), near AS (
  SELECT word, count(*) AS n_near, max(other_n) AS most FROM edits GROUP BY word
), forms AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * n THEN most END AS form_n,
    CASE WHEN most >= 5 * n THEN (SELECT min(other) FROM edits WHERE edits.word = words.word AND other_n = most) END AS form
  FROM words LEFT JOIN near ON words.word = near.word
), climb AS (
  SELECT word, word AS at FROM forms
  UNION ALL
  SELECT climb.word, form FROM climb JOIN forms ON forms.word = climb.at WHERE form IS NOT NULL
)
SELECT forms.word, forms.form, climb.at AS root, forms.n, forms.n_near, forms.form_n
FROM forms JOIN climb ON climb.word = forms.word JOIN forms last ON last.word = climb.at AND last.form IS NULL
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_metric_range_join": _OP2,
        "op7_byte_prefix_shards": _OP7,
        "op8_grace_dedup": _OP8,
        "op11_merkle_climb": _OP11,
        "op13_partenum_spellings": _OP13,
    }
