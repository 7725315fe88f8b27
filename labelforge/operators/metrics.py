"""Classification metrics, confusion matrices and error analysis.

Everything starts from one **pair-count table**
``groupBy(model, true_label, pred_label).count()`` -- a partial + final hash
aggregate whose output is bounded by models x labels^2 no matter how many rows
or how skewed the labels are.  All metric tables are then computed from it;
per-row tables (E3, E12, E13) read the records directly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import LABEL_SCHEMA, NONE_LABEL, PARSING_ERROR, STATUS_BANDS, STATUS_ELSE
from ..functions.text import in_list, plan_barrier, str_array, str_map_to_int

R = 6  # ratios are rounded to 6 decimals (float sum order varies)


def _div(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _r(c: Column) -> Column:
    return F.round(c.cast("double"), R)


def pair_counts(preds: DataFrame, first: str | None = None) -> DataFrame:
    """(model, true_label, pred_label, n), with ``first`` (a column such as item_id) also
    ``first``: its smallest value, where the pair appears first.

    The count passes through ``plan_barrier`` so that filters of the metric
    jobs stay above the aggregate: every consumer then shares one identical
    scan + partial aggregation + exchange, which Spark reuses within a query.
    """
    more = [F.min(first).alias("first")] if first else []
    agg = preds.groupBy("model", "true_label", "pred_label").agg(F.count(F.lit(1)).alias("n"), *more)
    return agg.select("model", "true_label", "pred_label", plan_barrier(F.col("n")).cast("long").alias("n"), *["first"] * len(more))


def _valid(pairs: DataFrame) -> DataFrame:
    return pairs.filter(~F.col("pred_label").eqNullSafe(F.lit(PARSING_ERROR)))


def _model_labels(pairs: DataFrame, labels: list[str]) -> DataFrame:
    """(model, label_ord, label) for every model x schema label, by a generator
    over the (few) model rows -- no join."""
    arr = str_array(labels)
    return (pairs.select("model").distinct()
            .select("model", F.posexplode(arr).alias("label_ord", "label")))


def per_class(pairs: DataFrame, labels: list[str] = LABEL_SCHEMA) -> DataFrame:
    """E5: per class tp, predicted, support, precision, recall, f1 (parse errors removed).

    ``predicted`` counts every valid row predicting the class, including rows
    whose truth is outside the schema (they are false positives).
    """
    v = _valid(pairs)
    # each valid pair counts once on its truth side and once on its prediction side
    sides = F.array(
        F.struct(F.col("true_label").alias("label"), F.col("n").alias("sup"),
                 F.when(F.col("pred_label") == F.col("true_label"), F.col("n")).otherwise(F.lit(0)).alias("tp"),
                 F.lit(0).cast("long").alias("pred")),
        F.struct(F.col("pred_label").alias("label"), F.lit(0).cast("long").alias("sup"),
                 F.lit(0).cast("long").alias("tp"), F.col("n").alias("pred")))
    by_label = (v.select("model", F.explode(sides).alias("s"))
                .groupBy("model", F.col("s.label").alias("label"))
                .agg(F.sum("s.sup").alias("support"), F.sum("s.tp").alias("tp"), F.sum("s.pred").alias("predicted")))
    base = _model_labels(pairs, labels)
    x = (base.join(by_label, ["model", "label"], "left")
         .select("model", "label_ord", "label",
                 F.coalesce("tp", F.lit(0)).cast("long").alias("tp"),
                 F.coalesce("predicted", F.lit(0)).cast("long").alias("predicted"),
                 F.coalesce("support", F.lit(0)).cast("long").alias("support")))
    tp, pr, su = F.col("tp"), F.col("predicted"), F.col("support")
    return x.select("*", _div(tp, pr).alias("precision"), _div(tp, su).alias("recall"),
                    _div(2 * tp, su + pr).alias("f1"))


def summary(preds_or_pairs: DataFrame, labels: list[str] = LABEL_SCHEMA, is_pairs: bool = False) -> DataFrame:
    """E1 + E2 + E4 + E6: one row per model."""
    pairs = preds_or_pairs if is_pairs else pair_counts(preds_or_pairs)
    n, t, p = F.col("n"), F.col("true_label"), F.col("pred_label")
    correct = p.eqNullSafe(t)
    non_none = ~t.eqNullSafe(F.lit(NONE_LABEL))
    parse_err = p.eqNullSafe(F.lit(PARSING_ERROR))
    base = pairs.groupBy("model").agg(
        F.sum(n).alias("total_count"),
        F.sum(F.when(correct, n).otherwise(0)).alias("correct_count"),
        F.sum(F.when(non_none, n).otherwise(0)).alias("non_none_total_count"),
        F.sum(F.when(non_none & correct, n).otherwise(0)).alias("non_none_correct_count"),
        F.sum(F.when(parse_err, n).otherwise(0)).alias("parsing_errors_count"),
    )
    pc = per_class(pairs, labels)
    w = pc.groupBy("model").agg(
        F.sum("support").alias("_sup"),
        F.sum(F.col("precision") * F.col("support")).alias("_p"),
        F.sum(F.col("recall") * F.col("support")).alias("_r"),
        F.sum(F.col("f1") * F.col("support")).alias("_f"))
    x = base.join(w, "model", "left")
    return x.select(
        "model",
        _r(_div(F.col("correct_count"), F.col("total_count"))).alias("accuracy"),
        F.col("correct_count").cast("long").alias("correct_count"),
        F.col("total_count").cast("long").alias("total_count"),
        _r(_div(F.col("non_none_correct_count"), F.col("non_none_total_count"))).alias("non_none_accuracy"),
        F.col("non_none_correct_count").cast("long").alias("non_none_correct_count"),
        F.col("non_none_total_count").cast("long").alias("non_none_total_count"),
        (F.col("total_count") - F.col("parsing_errors_count")).cast("long").alias("valid_predictions_count"),
        F.col("parsing_errors_count").cast("long").alias("parsing_errors_count"),
        _r(_div(F.col("_p"), F.col("_sup"))).alias("precision"),
        _r(_div(F.col("_r"), F.col("_sup"))).alias("recall"),
        _r(_div(F.col("_f"), F.col("_sup"))).alias("f1_score"),
    )


def per_class_report(pairs: DataFrame, labels: list[str] = LABEL_SCHEMA) -> DataFrame:
    """E5 output form with rounded ratios."""
    pc = per_class(pairs, labels)
    return pc.select("model", "label_ord", "label", "tp", "predicted", "support",
                     _r(F.col("precision")).alias("precision"), _r(F.col("recall")).alias("recall"),
                     _r(F.col("f1")).alias("f1"))


def class_report(pairs: DataFrame, labels: list[str] = LABEL_SCHEMA) -> DataFrame:
    """Per-class rows + ``accuracy`` (or ``micro avg``) + macro + weighted rows.

    ``accuracy`` replaces ``micro avg`` when every label seen on valid rows, truth or
    prediction, is in the schema.  Macro averages over all schema classes.  Models without valid
    rows get no rows.
    """
    pc = per_class(pairs, labels)
    v = _valid(pairs)
    cover = v.groupBy("model").agg(
        F.sum("n").alias("_valid"),
        F.sum(F.when(in_list("true_label", labels) & in_list("pred_label", labels), 0).otherwise(F.col("n"))).alias("_outside"))
    tot = pc.groupBy("model").agg(
        F.sum("tp").alias("tp"), F.sum("predicted").alias("pr"), F.sum("support").alias("su"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        F.sum(F.col("precision") * F.col("support")).alias("wp"),
        F.sum(F.col("recall") * F.col("support")).alias("wr"),
        F.sum(F.col("f1") * F.col("support")).alias("wf"))
    t = tot.join(cover, "model")  # inner: models with valid rows only
    su = F.col("su")
    micro_f = _div(2 * F.col("tp"), su + F.col("pr"))
    is_acc = F.col("_outside") == 0
    rows_avg = t.select("model", F.explode(F.array(
        F.struct(F.when(is_acc, "accuracy").otherwise("micro avg").alias("row_name"),
                 F.lit(len(labels)).alias("row_ord"),
                 F.when(is_acc, F.lit(None).cast("double")).otherwise(_div(F.col("tp"), F.col("pr"))).alias("precision"),
                 F.when(is_acc, F.lit(None).cast("double")).otherwise(_div(F.col("tp"), su)).alias("recall"),
                 micro_f.alias("f1_score"), su.alias("support")),
        F.struct(F.lit("macro avg").alias("row_name"), F.lit(len(labels) + 1).alias("row_ord"),
                 F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                 F.col("mf").alias("f1_score"), su.alias("support")),
        F.struct(F.lit("weighted avg").alias("row_name"), F.lit(len(labels) + 2).alias("row_ord"),
                 _div(F.col("wp"), su).alias("precision"), _div(F.col("wr"), su).alias("recall"),
                 _div(F.col("wf"), su).alias("f1_score"), su.alias("support")),
    )).alias("r")).select("model", "r.*")
    rows_cls = pc.join(cover.select("model"), "model").select(
        "model", F.col("label").alias("row_name"), F.col("label_ord").alias("row_ord"),
        F.col("precision"), F.col("recall"), F.col("f1").alias("f1_score"), F.col("support"))
    out = rows_cls.unionByName(rows_avg)
    return out.select("model", "row_name", F.col("row_ord").cast("int").alias("row_ord"),
                      _r(F.col("precision")).alias("precision"), _r(F.col("recall")).alias("recall"),
                      _r(F.col("f1_score")).alias("f1_score"), F.col("support").cast("long").alias("support"))


def confusion_fixed(pairs: DataFrame, labels: list[str] = LABEL_SCHEMA) -> DataFrame:
    """Dense ``len(labels)^2`` matrix per model in long form (true_ord, pred_ord, n).

    Parse errors and out-of-schema pairs are excluded; empty cells are 0.
    """
    k = len(labels)
    dim = str_array(labels)
    v = _valid(pairs)
    ords = str_map_to_int(labels)
    cells = (v.select("model", ords[F.col("true_label")].alias("true_ord"),
                      ords[F.col("pred_label")].alias("pred_ord"), "n")
             .filter(F.col("true_ord").isNotNull() & F.col("pred_ord").isNotNull())
             .groupBy("model", "true_ord", "pred_ord").agg(F.sum("n").alias("n")))
    grid = (pairs.select("model").distinct()
            .select("model", F.explode(F.sequence(F.lit(0), F.lit(k * k - 1))).alias("c"))
            .select("model", (F.col("c") / k).cast("int").alias("true_ord"),
                    (F.col("c") % k).cast("int").alias("pred_ord")))
    out = grid.join(cells, ["model", "true_ord", "pred_ord"], "left")
    return out.select("model", "true_ord", "pred_ord",
                      F.element_at(dim, F.col("true_ord") + 1).alias("true_label"),
                      F.element_at(dim, F.col("pred_ord") + 1).alias("pred_label"),
                      F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def confusion_wide(pairs: DataFrame, labels: list[str] = LABEL_SCHEMA) -> DataFrame:
    """E8 as a matrix: one row per model and true label, one column ``p<ord>`` per
    predicted label, row_total besides; parse errors and out-of-schema pairs are excluded.
    One aggregate: every model brings a row of zeros per label along."""
    ords = str_map_to_int(labels)
    cells = _valid(pairs).select("model", ords[F.col("true_label")].alias("true_ord"), ords[F.col("pred_label")].alias("pred_ord"), "n")
    cells = cells.filter(F.col("true_ord").isNotNull() & F.col("pred_ord").isNotNull())
    zeros = pairs.select("model", F.explode(F.sequence(F.lit(0), F.lit(len(labels) - 1))).alias("true_ord"),
                         F.lit(None).cast("int").alias("pred_ord"), F.lit(0).cast("long").alias("n"))
    columns = [F.sum(F.when(F.col("pred_ord") == i, F.col("n")).otherwise(0)).cast("long").alias(f"p{i}") for i in range(len(labels))]
    wide = cells.unionByName(zeros).groupBy("model", "true_ord").agg(*columns, F.sum("n").cast("long").alias("row_total"))
    return wide.select("model", "true_ord", F.element_at(str_array(labels), F.col("true_ord") + 1).alias("true_label"),
                       *[f"p{i}" for i in range(len(labels))], "row_total")


def confusion_used(pairs: DataFrame, classes: DataFrame, models: list[str]) -> DataFrame:
    """Matrix over the classes in use (L4), parse errors as a class.

    A prediction outside the classes folds into PARSING_ERROR when that class
    exists, else the row is dropped; rows whose truth is not a class are
    dropped.  ``vmax`` is the largest cell over all models (shared scale).
    """
    arr = classes.agg(F.sort_array(F.collect_list(F.struct("class_ord", "label"))).alias("a"))
    grid = (arr.select(F.explode(F.array(*[F.lit(m) for m in models])).alias("model"), "a")
            .select("model", "a", F.explode("a").alias("t"))
            .select("model", "t", F.explode("a").alias("p"))
            .select("model", F.col("t.label").alias("true_label"), F.col("t.class_ord").alias("true_ord"),
                    F.col("p.label").alias("pred_label"), F.col("p.class_ord").alias("pred_ord")))
    folded = _fold_preds(pairs, classes)
    cells = folded.groupBy("model", "true_label", "pred_label").agg(F.sum("n").alias("n"))
    out = grid.join(cells, ["model", "true_label", "pred_label"], "left").select(
        "model", "true_label", "pred_label", "true_ord", "pred_ord",
        F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    # grid is models x (|schema|+1)^2 rows at most: a bounded single-partition window.
    return out.withColumn("vmax", F.max("n").over(Window.partitionBy(F.lit(0))))


def _fold_preds(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Predictions outside the classes become PARSING_ERROR; rows then need both
    labels to be classes (so the fold only survives when that class exists)."""
    cls = classes.select(F.col("label").alias("_lab"))
    x = pairs.join(cls, F.col("pred_label") == F.col("_lab"), "left")
    pred = F.when(F.col("_lab").isNotNull(), F.col("pred_label")).otherwise(F.lit(PARSING_ERROR))
    y = x.select("model", "true_label", pred.alias("pred_label"), "n")
    y = y.join(cls, F.col("pred_label") == F.col("_lab"), "left_semi")
    return y.join(cls, F.col("true_label") == F.col("_lab"), "left_semi")


def error_rows(preds: DataFrame) -> DataFrame:
    """Records whose prediction differs from the truth (parse errors included)."""
    return preds.filter(~F.col("pred_label").eqNullSafe(F.col("true_label")))


def error_key() -> Column:
    none = F.lit("None")
    return F.concat(F.coalesce(F.col("true_label"), none), F.lit(" -> "), F.coalesce(F.col("pred_label"), none))


def error_breakdown(pairs: DataFrame, top_n: int | None = 10, ties: str = "key") -> DataFrame:
    """``"true -> pred"`` error counts per model, top N by count.  Ties by key, or
    (``ties="first"``, pair counts with ``first``) by where the error appears first."""
    more = [F.min("first").alias("first")] if ties == "first" else []
    e = error_rows(pairs).groupBy("model", error_key().alias("error_type")).agg(F.sum("n").cast("long").alias("n"), *more)
    if top_n is None:
        return e
    w = Window.partitionBy("model").orderBy(F.col("n").desc(), *["first"] * len(more), F.col("error_type"))
    return e.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_n)


def diagnostic_summary(diag: DataFrame) -> DataFrame:
    """Failure counts by error code per model, with total failures and size."""
    code = F.when(F.col("ok"), F.lit(None)).otherwise(F.coalesce("error_code", F.lit("UNKNOWN")))
    g = diag.groupBy("model", code.alias("error_code")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("model")
    x = g.select("*", F.sum("n").over(w).alias("size"),
                 F.sum(F.when(F.col("error_code").isNotNull(), F.col("n")).otherwise(0)).over(w).alias("total_errors"))
    return x.filter(F.col("error_code").isNotNull()).select(
        "model", "error_code", F.col("n").cast("long"), F.col("total_errors").cast("long"), F.col("size").cast("long"))


def both_failed(diag: DataFrame, models: list[str]) -> DataFrame:
    """Items failing under every listed model (one aggregate: a flag per model)."""
    flags = [F.max(F.when(F.col("model") == m, ~F.col("ok")).otherwise(False)).alias(f"_m{i}") for i, m in enumerate(models)]
    every = F.lit(True)
    for i in range(len(models)):
        every = every & F.col(f"_m{i}")
    return diag.groupBy("item_id").agg(*flags).filter(every).select("item_id")


_WORD_BITS = 62     # models per word of a mask


def _failure_masks(models: list[str], failed: Column) -> list[Column]:
    """Aggregates: bit i of word w is set when model 62 * w + i has a failed row."""
    ordinal = str_map_to_int(models)[F.col("model")]
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (ordinal % _WORD_BITS).cast("int"))
    return [F.bit_or(F.when(failed & (F.floor(ordinal / _WORD_BITS) == w), bit).otherwise(F.lit(0).cast("long"))).alias(f"_w{w}")
            for w in range(-(-len(models) // _WORD_BITS))]


def _by_failing_models(keys: DataFrame, models: list[str], n: str) -> DataFrame:
    """(models, n_models, <n>): how many keys fail under exactly each set of models."""
    words = [c for c in keys.columns if c.startswith("_w")]
    sets = keys.filter(" OR ".join(f"{w} <> 0" for w in words)).groupBy(*words).agg(F.count(F.lit(1)).alias(n))
    named = F.array_compact(F.array(*[
        F.when(F.col(f"_w{i // _WORD_BITS}").bitwiseAND(F.lit(1 << i % _WORD_BITS)) != 0, F.lit(m)) for i, m in enumerate(models)]))
    return sets.select(F.array_join(named, ",").alias("models"), F.size(named).alias("n_models"), n)


def failing_sets(diag: DataFrame, models: list[str]) -> DataFrame:
    """E12 for any number of models: (models, n_models, n_items), one row per set of models
    that fail together on an item, and under no other listed model.  One mask per item."""
    keys = diag.filter(F.col("model").isin(models)).groupBy("item_id").agg(*_failure_masks(models, ~F.col("ok")))
    return _by_failing_models(keys, models, "n_items")


def error_type_sets(pairs: DataFrame, models: list[str]) -> DataFrame:
    """C5 for any number of models: (models, n_models, n_error_types), the error types
    that exactly these models make."""
    keys = error_rows(pairs).filter(F.col("model").isin(models)).groupBy(error_key().alias("error_type")).agg(
        *_failure_masks(models, F.lit(True)))
    return _by_failing_models(keys, models, "n_error_types")


def first_failures(diag: DataFrame, k: int = 3) -> DataFrame:
    """First ``k`` failing records per model by item_id.

    ``row_number() <= k`` is planned with a per-partition group limit before
    the shuffle, so each task ships at most ``k`` rows per model.
    """
    w = Window.partitionBy("model").orderBy("item_id")
    return (diag.filter(~F.col("ok")).withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k))


def run_summary(summ: DataFrame, meta: dict, excluded: DataFrame | None = None, run: dict | None = None) -> DataFrame:
    """Display name, source and status band per model.

    ``meta``: ``{model: {"display_name", "model_path", "use_local_model", "base_model"}}``.
    ``excluded``: the one-row NONE-filter counts (F4), giving ``excluded_none``.
    ``run``: what the run itself knows, ``{"test_data_path", "timestamp"}``.
    """
    def m(field, default):
        e = F.lit(default)
        for name, d in meta.items():
            e = F.when(F.col("model") == name, F.lit(d.get(field, default))).otherwise(e)
        return e
    path = m("model_path", "")
    source = (F.when(F.lower(path).contains("openrouter"), "OpenRouter API")
              .when(m("use_local_model", True), "Local").otherwise("Hugging Face Hub"))
    status = F.lit(STATUS_ELSE)
    for thr, name in reversed(STATUS_BANDS):
        status = F.when(F.col("accuracy") >= thr, F.lit(name)).otherwise(status)
    more = []
    if run is not None:
        count = F.lit(None).cast("long") if excluded is None else excluded.select("excluded").scalar()
        more = [count.alias("excluded_none"), F.lit(run.get("test_data_path")).cast("string").alias("test_data_path"),
                m("base_model", "").alias("base_model"), F.lit(run.get("timestamp")).cast("string").alias("timestamp")]
    return summ.select("model", m("display_name", "").alias("display_name"), path.alias("model_path"),
                       source.alias("model_source"), "accuracy", "correct_count", "total_count",
                       status.alias("status"), *more)
