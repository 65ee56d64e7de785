"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 code points that count as white space at the ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: what separates words (anything that is no letter and no digit).
WORD_BREAK = r"[^\p{L}\p{N}]+"

# Fixed values of the hover text and of a missing label.
HOVER_CHARS = 80
NOISE_NAME = "noise"
UNLABELED = "Unlabeled"


def strip(col: Column) -> Column:
    """Remove white space at both ends; inner white space stays."""
    return F.trim(col.cast("string"), F.lit(WHITESPACE))


def collapse_spaces(col: Column) -> Column:
    """Turn each inner run of white space into one space."""
    return F.regexp_replace(col, f"[{WHITESPACE}]+", " ")


def words(col: Column) -> Column:
    """Lower-cased words of a text."""
    return F.filter(F.split(F.lower(col), WORD_BREAK), lambda w: w != "")


def hover(cluster_id: Column, label: Column, text: Column) -> Column:
    """Text shown for one point of the cluster map."""
    tail = F.when(F.char_length(text) > HOVER_CHARS, "...").otherwise("")
    return F.concat(
        F.lit("cluster "),
        cluster_id.cast("string"),
        F.lit(": "),
        F.coalesce(label, F.lit(NOISE_NAME)),
        F.lit("<br>"),
        F.substring(text, 1, HOVER_CHARS),
        tail,
    )


def band(value: Column, warn_below: float, good_above: float) -> Column:
    """``good``, ``warn`` or ``mid`` for one metric; null or NaN is ``undefined``."""
    return (
        F.when(value.isNull() | F.isnan(value), "undefined")
        .when(value >= good_above, "good")
        .when(value < warn_below, "warn")
        .otherwise("mid")
    )
