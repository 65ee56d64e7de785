"""Clean utterances and keep human labels apart."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themewell.functions import text as tx


class HeldOut(NamedTuple):
    """Text to cluster, and the labels kept for the final check only."""

    texts: DataFrame  # id, text
    labels: DataFrame  # id, category, intent


def clean_text(df: DataFrame, text_col: str = "text", collapse_inner: bool = False) -> DataFrame:
    """Strip both ends and drop null or empty texts."""
    stripped = tx.strip(F.col(text_col))
    if collapse_inner:
        stripped = tx.collapse_spaces(stripped)
    return df.withColumn(text_col, stripped).where(F.length(text_col) > 0)


def dedupe_first(df: DataFrame, text_col: str = "text", id_col: str = "id") -> DataFrame:
    """Keep the row with the least id of each exact, case-sensitive text.

    The first pass shuffles a digest and an id per row and combines copies
    before the shuffle, so a text that fills a third of the table costs one row
    per task. The second pass keeps the surviving ids.
    """
    first = (
        df.groupBy(F.sha2(F.col(text_col), 256).alias("_digest"))
        .agg(F.min(id_col).alias(id_col))
        .select(id_col)
    )
    return df.join(first, id_col, "left_semi")


def label_conflicts(
    df: DataFrame, label_cols: Sequence[str], text_col: str = "text"
) -> DataFrame:
    """One row: how many distinct texts there are, and how many carry unlike labels."""
    per_text = df.groupBy(F.sha2(F.col(text_col), 256).alias("_digest")).agg(
        *[F.min(c).alias(f"_min_{c}") for c in label_cols],
        *[F.max(c).alias(f"_max_{c}") for c in label_cols],
    )
    unlike = F.lit(False)
    for c in label_cols:
        unlike = unlike | (F.col(f"_min_{c}") != F.col(f"_max_{c}"))
    return per_text.agg(
        F.count(F.lit(1)).alias("n_texts"), F.count_if(unlike).alias("n_conflicting")
    )


def split_heldout(
    df: DataFrame,
    id_col: str = "id",
    text_col: str = "text",
    category_col: str = "category",
    intent_col: str = "intent",
) -> HeldOut:
    """Two frames on one key; the texts frame cannot carry a label."""
    return HeldOut(
        texts=df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")),
        labels=df.select(
            F.col(id_col).alias("id"),
            F.col(category_col).alias("category"),
            F.col(intent_col).alias("intent"),
        ),
    )


def label_profile(labels: DataFrame) -> DataFrame:
    """One row: number of categories and intents, and the sorted category names."""
    return labels.agg(
        F.countDistinct("category").alias("n_category"),
        F.countDistinct("intent").alias("n_intent"),
        F.array_sort(F.collect_set("category")).alias("categories"),
    )
