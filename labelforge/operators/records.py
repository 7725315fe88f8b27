"""Record normalisation, NONE filters, caps, projection, preview, truncation (F1-F8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.constants import NONE_LABEL, RESPONSE_TRUNCATE
from ..functions.text import py_strip, strip_or_empty, truncate_text
from .ranking import first_k, number_bucket

TEXT_FIELDS = ["clause", "clause_with_context", "rationale"]


def normalize(df: DataFrame, unknown_default: str = "") -> DataFrame:
    """F1 + F2: strip text fields and the label; blank contract type -> default.

    Text fields: ``(x or "").strip()``.  Label: stripped, null stays null.
    ``unknown_default`` is ``""`` (training prompts) or ``"Unknown"``
    (notebook inference prompts).
    """
    ct = strip_or_empty("contract_type")
    cols = []
    for c in df.columns:
        if c in TEXT_FIELDS:
            cols.append(strip_or_empty(c).alias(c))
        elif c == "contract_type":
            cols.append(F.when(ct == "", F.lit(unknown_default)).otherwise(ct).alias(c))
        elif c == "label":
            cols.append(py_strip("label").alias("label"))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def is_none_loose(label="label"):
    return F.upper(strip_or_empty(label)) == F.lit(NONE_LABEL)


def drop_none_loose(df: DataFrame, label: str = "label") -> DataFrame:
    """drop rows whose label strips/upper-cases to NONE; null is kept."""
    return df.filter(~is_none_loose(label))


def drop_none_exact(df: DataFrame, label: str = "label") -> DataFrame:
    """drop rows whose label is exactly ``NONE``; null and ' none ' are kept."""
    return df.filter(~F.col(label).eqNullSafe(F.lit(NONE_LABEL)))


def none_filter_counts(df: DataFrame, label: str = "label", loose: bool = False) -> DataFrame:
    """Kept / excluded / total counts of a NONE filter in one aggregate."""
    dropped = is_none_loose(label) if loose else F.col(label).eqNullSafe(F.lit(NONE_LABEL))
    return df.agg(F.count(F.lit(1)).alias("total"),
                  F.count_if(dropped).alias("excluded"),
                  F.count_if(~dropped).alias("kept"))


def drop_none_observed(df: DataFrame, loose: bool = False, label: str = "label") -> tuple[DataFrame, Observation]:
    """F3 / F4 with their counts: the kept rows, and an observation that the job which
    produces them fills (``get``: total, excluded), without a scan of its own."""
    seen = Observation()
    dropped = is_none_loose(label) if loose else F.col(label).eqNullSafe(F.lit(NONE_LABEL))
    counted = df.observe(seen, F.count(F.lit(1)).alias("total"), F.count_if(dropped).alias("excluded"))
    return counted.filter(~dropped), seen


def cap_first_n(df: DataFrame, n: int | None, mode: str = "pipeline", order_col: str = "item_id",
                by_split: bool = True) -> DataFrame:
    """first ``n`` records (by ``order_col``) -- per split when ``by_split``,
    whatever the splits are called (a null split is one).

    ``mode="pipeline"``: 0 or None means no cap.  ``mode="notebook"``: only
    None means no cap; 0 gives an empty result.
    """
    if n is None or (mode == "pipeline" and n == 0):
        return df
    return first_k(df, [order_col], n, number_bucket(order_col), ["split"] if by_split else None)


def drop_teacher_columns(df: DataFrame) -> DataFrame:
    """drop the teacher's output columns."""
    return df.drop("rationale", "reasoning_trace")


def only_text(df: DataFrame) -> DataFrame:
    """replace all columns by ``text``."""
    return df.select("text")


def preview(df: DataFrame, item_id: int) -> DataFrame:
    """the record at a given position key."""
    return df.filter(F.col("item_id") == F.lit(item_id))


def truncate_responses(df: DataFrame, col: str = "response", limit: int = RESPONSE_TRUNCATE) -> DataFrame:
    """F8: truncate a text column to ``limit`` code points + '...'; null -> ''."""
    return df.withColumn(col, truncate_text(col, limit))
