"""Two-model comparison and label / split distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import BATCH_SIZE, GRAD_ACCUMULATION, NONE_LABEL, NUM_EPOCHS
from .metrics import R, _div, _r, error_key, error_rows
from .records import is_none_loose

METRICS = ["accuracy", "non_none_accuracy", "precision", "recall", "f1_score"]


def _pick(model: str, c: str) -> Column:
    return F.max(F.when(F.col("model") == model, F.col(c)))


def _pct(d: Column, base: Column) -> Column:
    return F.when(base > 0, d / base * 100).otherwise(F.lit(0.0))


def compare_summary(summ: DataFrame, candidate: str, baseline: str) -> DataFrame:
    """One row of candidate-vs-baseline figures from two summary rows.

    C3 clean accuracy is given in both modes: ``*_clean_accuracy`` follows the
    reference rule (the candidate divides by all samples; only the baseline
    drops its parse errors; both use the candidate's total), and
    ``*_clean_accuracy_sym`` drops each model's own parse errors.
    """
    cols = METRICS + ["correct_count", "total_count", "parsing_errors_count"]
    one = summ.agg(*[_pick(m, c).alias(f"{p}_{c}") for p, m in (("c", candidate), ("b", baseline)) for c in cols])
    c = lambda k: F.col(f"c_{k}")
    b = lambda k: F.col(f"b_{k}")
    total = c("total_count")
    c_clean = _div(c("correct_count"), total)
    b_clean_total = total - b("parsing_errors_count")
    b_clean = _div(b("correct_count"), b_clean_total)
    c_sym = _div(c("correct_count"), c("total_count") - c("parsing_errors_count"))
    b_sym = _div(b("correct_count"), b("total_count") - b("parsing_errors_count"))
    out = [F.lit(candidate).alias("candidate"), F.lit(baseline).alias("baseline")]
    for m in METRICS:
        out += [_r(c(m)).alias(f"candidate_{m}"), _r(b(m)).alias(f"baseline_{m}"),
                _r(c(m) - b(m)).alias(f"{m}_improvement")]
    out += [
        _r(_pct(c("accuracy") - b("accuracy"), b("accuracy"))).alias("overall_improvement_pct"),
        _r(_pct(c("non_none_accuracy") - b("non_none_accuracy"), b("non_none_accuracy"))).alias("non_none_improvement_pct"),
        _r(c_clean).alias("candidate_clean_accuracy"), _r(b_clean).alias("baseline_clean_accuracy"),
        c("correct_count").alias("candidate_clean_correct"), b("correct_count").alias("baseline_clean_correct"),
        total.alias("candidate_clean_total"), b_clean_total.alias("baseline_clean_total"),
        _r(c_clean - b_clean).alias("clean_improvement"),
        _r(_pct(c_clean - b_clean, b_clean)).alias("clean_improvement_pct"),
        _r(c_sym).alias("candidate_clean_accuracy_sym"), _r(b_sym).alias("baseline_clean_accuracy_sym"),
        c("correct_count").alias("candidate_correct"), b("correct_count").alias("baseline_correct"),
        total.alias("total_samples"),
        c("parsing_errors_count").alias("candidate_parsing_errors"),
        b("parsing_errors_count").alias("baseline_parsing_errors"),
        (b("parsing_errors_count") - c("parsing_errors_count")).alias("parsing_error_reduction"),
        (c("total_count") - c("correct_count")).alias("candidate_total_errors"),
        (b("total_count") - b("correct_count")).alias("baseline_total_errors"),
    ]
    return one.select(*out)


def outcome(delta: Column) -> Column:
    """Improvement / Regression / No Change."""
    return F.when(delta > 0, "Improvement").when(delta < 0, "Regression").otherwise("No Change")


def compare_metrics(summ: DataFrame, candidate: str, baseline: str) -> DataFrame:
    """C1 + C2 + C6 in long form: (metric, candidate, baseline, delta, delta_pct, outcome)."""
    one = summ.agg(*[_pick(m, k).alias(f"{p}_{k}") for p, m in (("c", candidate), ("b", baseline)) for k in METRICS])
    rows = F.array(*[F.struct(F.lit(k).alias("metric"), F.col(f"c_{k}").cast("double").alias("cv"),
                              F.col(f"b_{k}").cast("double").alias("bv")) for k in METRICS])
    x = one.select(F.explode(rows).alias("r")).select("r.*")
    d = F.col("cv") - F.col("bv")
    return x.select("metric", _r(F.col("cv")).alias("candidate"), _r(F.col("bv")).alias("baseline"),
                    _r(d).alias("delta"), _r(_pct(d, F.col("bv"))).alias("delta_pct"), outcome(_r(d)).alias("outcome"))


def error_type_overlap(pairs: DataFrame, candidate: str, baseline: str) -> DataFrame:
    """Number of error types common to both models and unique to each."""
    e = error_rows(pairs).filter(F.col("model").isin(candidate, baseline))
    t = e.groupBy(error_key().alias("error_type")).agg(
        F.max((F.col("model") == candidate).cast("int")).alias("in_c"),
        F.max((F.col("model") == baseline).cast("int")).alias("in_b"))
    return t.agg(
        F.count_if((F.col("in_c") == 1) & (F.col("in_b") == 1)).alias("common_error_types"),
        F.count_if((F.col("in_c") == 1) & (F.col("in_b") == 0)).alias("candidate_unique_error_types"),
        F.count_if((F.col("in_c") == 0) & (F.col("in_b") == 1)).alias("baseline_unique_error_types"))


def aligned(diag: DataFrame, teacher: str, student: str) -> DataFrame:
    """Gold, teacher and student labels side by side per item: one aggregate over
    (item_id, model, true_label, pred_label, ok) with one row per item and model."""
    def of(model, column):
        return F.max(F.when(F.col("model") == model, F.col(column)))
    return diag.filter(F.col("model").isin(teacher, student)).groupBy("item_id").agg(
        of(teacher, "true_label").alias("gold"), of(teacher, "pred_label").alias("teacher_label"),
        of(teacher, "ok").alias("teacher_ok"), of(student, "pred_label").alias("student_label"),
        of(student, "ok").alias("student_ok"))


def none_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """NONE vs other counts and percentages (null percentages on empty input)."""
    is_none = F.col(label).eqNullSafe(F.lit(NONE_LABEL))
    x = df.agg(F.count_if(is_none).alias("none_count"), F.count(F.lit(1)).alias("total"))
    tot = F.col("total")
    return x.select(F.col("none_count").cast("long"), (tot - F.col("none_count")).cast("long").alias("other_count"),
                    tot.cast("long").alias("total"),
                    F.when(tot > 0, F.round(F.col("none_count") / tot * 100, R)).alias("none_pct"),
                    F.when(tot > 0, F.round((tot - F.col("none_count")) / tot * 100, R)).alias("other_pct"))


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Non-NONE label counts, ascending (ties by label)."""
    return (df.filter(~F.col(label).eqNullSafe(F.lit(NONE_LABEL)))
            .groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
            .orderBy("n", "label"))


def split_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """D3: rows per split, share of total (0 when empty), NONE rows a loose filter drops."""
    g = df.groupBy("split").agg(F.count(F.lit(1)).alias("n"),
                                F.count_if(is_none_loose(label)).alias("none_filtered"))
    # one row per split: a bounded single-partition window
    tot = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return g.select("split", F.col("n").cast("long"), F.col("none_filtered").cast("long"),
                    F.when(tot > 0, F.round(F.col("n") / tot * 100, R)).otherwise(F.lit(0.0)).alias("pct"))


def step_estimate(df: DataFrame, label: str = "label", batch_size: int = BATCH_SIZE,
                  grad_accum: int = GRAD_ACCUMULATION, epochs: int = NUM_EPOCHS,
                  filter_none: bool = True) -> DataFrame:
    """Optimiser steps per split, ``(n // (batch * accum)) * epochs``."""
    x = df.filter(~is_none_loose(label)) if filter_none else df
    g = x.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    return g.select("split", F.col("n").cast("long"),
                    (F.floor(F.col("n") / F.lit(batch_size * grad_accum)) * epochs).cast("long").alias("steps"))
