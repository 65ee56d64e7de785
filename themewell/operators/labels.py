"""Names for clusters: prompts, a labeler the user brings, and keyword names."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from themewell.functions import text as tx
from themewell.operators.agreement import cluster_sizes, without_noise

# Tries per cluster, seconds between tries, and the reply's keys.
DEFAULT_MAX_RETRIES = 3
DEFAULT_RETRY_DELAY = 2.0
REPLY_SCHEMA = "label string, description string"

PROMPT_HEAD = (
    "The messages below were written to a support desk. They were put in one group because "
    "they mean nearly the same. Messages from the group:\n\n"
)
PROMPT_TAIL = (
    "\n\nAnswer with one JSON object and nothing else. Its key \"label\" holds a category name "
    "of 3 to 6 words, its key \"description\" holds one sentence on what the messages ask for."
)

TERM_SEPARATOR = " / "
DEFAULT_TERMS = 5


def prompt(example_texts: Column) -> Column:
    bullets = F.transform(example_texts, lambda t: F.concat(F.lit("- "), t))
    return F.concat(F.lit(PROMPT_HEAD), F.array_join(bullets, "\n"), F.lit(PROMPT_TAIL))


def label_requests(assigned: DataFrame, example_rows: DataFrame) -> DataFrame:
    """``cluster_id, size, examples, prompt``: one row per cluster."""
    return cluster_sizes(assigned).join(example_rows, "cluster_id").withColumn("prompt", prompt(F.col("examples")))


def apply_labeler(
    requests: DataFrame,
    make_labeler: Callable[[], Callable[[str], str]],
    max_retries: int = DEFAULT_MAX_RETRIES,
    retry_delay: float = DEFAULT_RETRY_DELAY,
    parallel_calls: int | None = None,
) -> DataFrame:
    """Ask the user's labeler for each prompt.

    ``make_labeler`` runs once per task and gives a function from prompt to
    reply. A reply that raises or is no JSON object counts as a failed try; the
    delay comes between tries, not after the last. A cluster that never gets a
    usable reply has ``status = 'failed'`` and the last ``error``; the others go
    on. ``parallel_calls`` sets how many tasks call the labeler at a time.
    """
    schema = "cluster_id int, reply string, error string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        label = make_labeler()
        for batch in batches:
            out = []
            for cluster_id, text in zip(batch["cluster_id"], batch["prompt"]):
                reply, error = None, None
                for attempt in range(max_retries):
                    if attempt:
                        time.sleep(retry_delay)
                    try:
                        answer = label(text)
                        if not isinstance(json.loads(answer), dict):
                            raise ValueError("the reply is no JSON object")
                        reply, error = answer, None
                        break
                    except Exception as exc:
                        error = f"{type(exc).__name__}: {exc}"
                out.append((cluster_id, reply, error))
            yield pd.DataFrame(out, columns=["cluster_id", "reply", "error"])

    asked = requests.select(F.col("cluster_id").cast("int"), "prompt")
    if parallel_calls:
        asked = asked.repartition(parallel_calls, "cluster_id")
    parsed = F.from_json("reply", REPLY_SCHEMA)
    named = F.coalesce(F.nullif(tx.strip(F.col("parsed.label")), F.lit("")), F.lit(tx.UNLABELED))
    done = F.col("error").isNull()
    return (
        asked.mapInPandas(run, schema)
        .withColumn("parsed", parsed)
        .select(
            "cluster_id",
            F.when(done, named).alias("label"),
            F.when(done, F.coalesce(tx.strip(F.col("parsed.description")), F.lit(""))).alias("description"),
            F.when(done, "done").otherwise("failed").alias("status"),
            "error",
        )
    )


def require_labels(labelled: DataFrame) -> DataFrame:
    """Raise if any cluster failed (the strict mode)."""
    failed = labelled.where(F.col("status") == "failed").select("cluster_id", "error").first()
    if failed:
        raise RuntimeError(
            f"no usable reply for cluster {failed['cluster_id']}; is the labeler reachable? "
            f"Last error: {failed['error']}"
        )
    return labelled


def keyword_terms(
    assigned: DataFrame, texts: DataFrame, n_terms: int = DEFAULT_TERMS, tasks: int | None = None
) -> DataFrame:
    """``cluster_id, rank, term, score``: class-based TF-IDF (Grootendorst 2022).

    score = tf(term, cluster) * ln(1 + A / f(term)), A = mean words per cluster,
    f = occurrences in all clusters. Ties go to the smaller term. Counts are
    combined before the shuffle, so neither a common word nor a large cluster
    gathers its occurrences in one task. Where texts come in a few large files,
    ``tasks`` deals them out by id over so many tasks first.
    """
    texts = texts if tasks is None else texts.repartition(tasks, "id")
    members = without_noise(assigned).select("id", "cluster_id").join(texts.select("id", "text"), "id")
    tf = (
        # The outer form splits each text once; the plain one adds a filter that splits it again.
        members.select("cluster_id", F.explode_outer(tx.words(F.col("text"))).alias("term"))
        .where(F.col("term").isNotNull())
        .groupBy("cluster_id", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    mean_words = tf.agg(F.sum("tf") / F.countDistinct("cluster_id")).scalar()
    in_all = F.sum("tf").over(Window.partitionBy("term"))
    scored = tf.withColumn("f", in_all).withColumn("mean_words", mean_words)
    score = F.col("tf") * F.log1p(F.col("mean_words") / F.col("f"))
    # Rounding first makes the order the same wherever sums are taken.
    scored = scored.select("cluster_id", "term", F.round(score, 6).alias("score"))
    order = Window.partitionBy("cluster_id").orderBy(F.desc("score"), "term")
    return (
        scored.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= n_terms)
        .select("cluster_id", "rank", "term", "score")
    )


def keyword_labels(terms: DataFrame) -> DataFrame:
    """``cluster_id, label, description`` from keyword terms: names without a model."""
    ranked = F.array_sort(F.collect_list(F.struct("rank", "term")))
    return (
        terms.groupBy("cluster_id")
        .agg(ranked.getField("term").alias("terms"))
        .select(
            "cluster_id",
            F.array_join("terms", TERM_SEPARATOR).alias("label"),
            F.concat(F.lit("Messages about "), F.array_join("terms", ", ")).alias("description"),
        )
    )
