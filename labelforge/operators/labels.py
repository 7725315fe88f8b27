"""Label dimension, valid-label lists, derived schemas, classes in use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.constants import LABEL_SCHEMA, NONE_LABEL, PARSING_ERROR
from ..functions.text import col_, in_list, strip_or_empty


def label_dim(spark: SparkSession, labels: list[str] = LABEL_SCHEMA) -> DataFrame:
    """L1: (label_ord, label), 0-based, order kept.  38 rows: broadcast freely."""
    return spark.createDataFrame(list(enumerate(labels)), "label_ord int, label string")


def valid_labels(include_none: bool = False, labels: list[str] = LABEL_SCHEMA) -> list[str]:
    """L2: prompt label list; NONE only when kept."""
    return list(labels) if include_none else [x for x in labels if x != NONE_LABEL]


def label_usage(df: DataFrame, labels: list[str] = LABEL_SCHEMA, label: str = "label") -> DataFrame:
    """L1 + L2: (label_ord, label, n, in_prompt, in_prompt_with_none): every label of the
    dimension in its order, how many records carry it (stripped; zero included), and
    whether the prompt's label list names it without and with NONE."""
    counts = df.groupBy(strip_or_empty(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    dim = label_dim(df.sparkSession, labels)
    return dim.join(counts, "label", "left").select(
        "label_ord", "label", F.coalesce("n", F.lit(0)).cast("long").alias("n"),
        in_list(F.col("label"), valid_labels(False, labels)).alias("in_prompt"),
        in_list(F.col("label"), valid_labels(True, labels)).alias("in_prompt_with_none"))


def derived_labels(df: DataFrame, label: str = "label") -> DataFrame:
    """L3: stripped, non-empty, non-NONE distinct labels, code-point order."""
    lab = strip_or_empty(label)
    return (df.select(lab.alias("label")).filter((F.col("label") != "") & (F.upper("label") != NONE_LABEL))
            .distinct().orderBy("label"))


def validate_label(c, labels: list[str] = LABEL_SCHEMA) -> Column:
    """The label when it is in the schema (exact, case-sensitive), else null."""
    c = col_(c)
    return F.when(in_list(c, labels), c)


def classes_in_use(pairs: DataFrame, base: DataFrame) -> DataFrame:
    """L4: base labels seen as truth or prediction, base order; ``PARSING_ERROR``
    appended when any prediction is a parse error.

    ``pairs``: (true_label, pred_label[, n]) -- typically the pair-count table.
    ``base``: (label_ord, label).  Output (class_ord, label), dense 0-based.
    """
    seen = (pairs.select(F.col("true_label").alias("label"))
            .unionByName(pairs.select(F.col("pred_label").alias("label"))))
    # the base may be derived from data: Spark broadcasts it only when its size allows
    used = seen.distinct().join(base, "label").select(F.lit(False).alias("_error"), "label_ord", "label")
    err = (pairs.filter(F.col("pred_label") == PARSING_ERROR).limit(1)
           .select(F.lit(True).alias("_error"), F.lit(0).alias("label_ord"), F.lit(PARSING_ERROR).alias("label")))
    w = Window.partitionBy(F.lit(0)).orderBy("_error", "label_ord")
    # classes in use are at most |base| + 1 rows: a single-partition window is bounded.
    return used.unionByName(err).select((F.row_number().over(w) - 1).alias("class_ord"), "label")
