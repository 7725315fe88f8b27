"""Hand-computed six-row metric fixture and metric identities."""

import pytest
from pyspark.sql import functions as F

from labelforge.operators import compare as C
from labelforge.operators import labels as L
from labelforge.operators import metrics as E

ROWS = [  # item, truth, prediction
    (1, "Audit Rights", "Audit Rights"),     # correct
    (2, "Insurance", "Audit Rights"),        # wrong
    (3, "Insurance", "PARSING_ERROR"),       # parse error
    (4, "NONE", "NONE"),                     # NONE truth
    (5, "Mystery", "Governing Law"),         # truth outside the schema
    (6, "Exclusivity", "Non-Compete"),       # class predicted but never true
]


@pytest.fixture(scope="module")
def preds(spark):
    return spark.createDataFrame([(i, "m", t, p) for i, t, p in ROWS],
                                 "item_id long, model string, true_label string, pred_label string")


@pytest.fixture(scope="module")
def pairs(preds):
    return E.pair_counts(preds)


def test_summary(pairs):
    r = E.summary(pairs, is_pairs=True).first().asDict()
    assert r["total_count"] == 6 and r["correct_count"] == 2
    assert r["accuracy"] == pytest.approx(2 / 6, abs=1e-6)
    assert r["non_none_total_count"] == 5 and r["non_none_correct_count"] == 1
    assert r["non_none_accuracy"] == pytest.approx(0.2)
    assert r["valid_predictions_count"] == 5 and r["parsing_errors_count"] == 1
    assert r["precision"] == pytest.approx(0.375)
    assert r["recall"] == pytest.approx(0.5)
    assert r["f1_score"] == pytest.approx((2 / 3 + 1) / 4, abs=1e-6)


def test_per_class(pairs):
    pc = {r["label"]: r for r in E.per_class_report(pairs).collect()}
    assert len(pc) == 38
    ar = pc["Audit Rights"]
    assert (ar["tp"], ar["predicted"], ar["support"]) == (1, 2, 1)
    assert (ar["precision"], ar["recall"], ar["f1"]) == (0.5, 1.0, pytest.approx(2 / 3, abs=1e-6))
    assert (pc["Insurance"]["support"], pc["Insurance"]["predicted"]) == (1, 0)   # parse error removed
    gl = pc["Governing Law"]                                                       # false positive on outside truth
    assert (gl["predicted"], gl["support"], gl["precision"]) == (1, 0, 0.0)
    assert pc["Non-Compete"]["precision"] == 0.0 and pc["Exclusivity"]["recall"] == 0.0
    assert pc["NONE"]["f1"] == 1.0


def test_class_report(pairs):
    rep = {r["row_name"]: r for r in E.class_report(pairs).collect()}
    assert "accuracy" not in rep                     # truth outside the schema -> micro avg
    mi = rep["micro avg"]
    assert (mi["precision"], mi["recall"]) == (0.4, 0.5)
    assert mi["f1_score"] == pytest.approx(4 / 9, abs=1e-6) and mi["support"] == 4
    ma = rep["macro avg"]
    assert ma["precision"] == pytest.approx(1.5 / 38, abs=1e-6)
    assert ma["f1_score"] == pytest.approx((2 / 3 + 1) / 38, abs=1e-6)
    assert rep["weighted avg"]["recall"] == 0.5


def test_accuracy_row_when_schema_covers(spark):
    p = spark.createDataFrame([(1, "m", "Insurance", "Insurance"), (2, "m", "NONE", "Insurance")],
                              "item_id long, model string, true_label string, pred_label string")
    rep = {r["row_name"]: r for r in E.class_report(E.pair_counts(p)).collect()}
    assert rep["accuracy"]["f1_score"] == 0.5 and rep["accuracy"]["precision"] is None


def test_confusion_identities(pairs, preds):
    cm = E.confusion_fixed(pairs)
    assert cm.count() == 38 * 38
    cells = {(r["true_label"], r["pred_label"]): r["n"] for r in cm.filter("n > 0").collect()}
    assert cells == {("Audit Rights", "Audit Rights"): 1, ("Insurance", "Audit Rights"): 1,
                     ("NONE", "NONE"): 1, ("Exclusivity", "Non-Compete"): 1}
    rows = {r["true_label"]: r["s"] for r in cm.groupBy("true_label").agg(F.sum("n").alias("s")).collect()}
    support = {r["label"]: r["support"] for r in E.per_class_report(pairs).collect()}
    assert rows == support                              # row sums = support (all truths in schema)
    s = E.summary(pairs, is_pairs=True).first()
    assert E.error_rows(preds).count() == s["total_count"] - s["correct_count"]


def test_confusion_used_and_classes(spark, pairs):
    classes = L.classes_in_use(pairs, L.label_dim(spark))
    got = [r["label"] for r in classes.orderBy("class_ord").collect()]
    assert got == ["Audit Rights", "Exclusivity", "Governing Law", "Insurance", "Non-Compete", "NONE", "PARSING_ERROR"]
    cu = E.confusion_used(pairs, classes, ["m"])
    assert cu.count() == 49
    assert cu.filter("true_label = 'Insurance' AND pred_label = 'PARSING_ERROR'").first()["n"] == 1
    assert cu.first()["vmax"] == 1


def test_error_breakdown_and_overlap(spark, pairs):
    eb = {r["error_type"]: r["n"] for r in E.error_breakdown(pairs, 10).collect()}
    assert eb == {"Insurance -> Audit Rights": 1, "Insurance -> PARSING_ERROR": 1,
                  "Mystery -> Governing Law": 1, "Exclusivity -> Non-Compete": 1}
    two = pairs.unionByName(pairs.filter("true_label = 'Insurance'").withColumn("model", F.lit("b")))
    ov = C.error_type_overlap(two, "m", "b").first()
    assert (ov[0], ov[1], ov[2]) == (2, 2, 0)


def test_empty_input(spark):
    p = spark.createDataFrame([], "item_id long, model string, true_label string, pred_label string")
    pc = E.pair_counts(p)
    assert E.summary(pc, is_pairs=True).count() == 0
    assert E.class_report(pc).count() == 0
    d = C.none_distribution(spark.createDataFrame([], "label string")).first()
    assert d["total"] == 0 and d["none_pct"] is None


def test_compare_clean_accuracy_modes(spark):
    summ = spark.createDataFrame(
        [("c", 0.5, 0.5, 0.5, 0.5, 0.5, 5, 10, 0), ("b", 0.4, 0.4, 0.4, 0.4, 0.4, 4, 10, 2)],
        "model string, accuracy double, non_none_accuracy double, precision double, recall double, "
        "f1_score double, correct_count long, total_count long, parsing_errors_count long")
    r = C.compare_summary(summ, "c", "b").first()
    assert r["candidate_clean_accuracy"] == 0.5 and r["baseline_clean_accuracy"] == 0.5   # 4 / (10 - 2)
    assert r["parsing_error_reduction"] == 2 and r["accuracy_improvement"] == pytest.approx(0.1)
    assert r["overall_improvement_pct"] == pytest.approx(25.0)


def test_sets_of_failing_models_beyond_one_word(spark):
    """70 models: bits in two words; ties and models that fail alone are kept apart."""
    models = [f"m{i}" for i in range(70)]
    fails = {1: ["m0"], 2: ["m0", "m69"], 3: ["m61", "m62", "m63"], 4: ["m69", "m0"], 5: []}
    rows = [(i, m, m not in bad) for i, bad in fails.items() for m in models] + [(1, "other", False)]
    df = spark.createDataFrame(rows, "item_id long, model string, ok boolean").repartition(5)
    got = {r["models"]: (r["n_models"], r["n_items"]) for r in E.failing_sets(df, models).collect()}
    assert got == {"m0": (1, 1), "m0,m69": (2, 2), "m61,m62,m63": (3, 1)}
    both = {r["item_id"] for r in E.both_failed(df, ["m0", "m69"]).collect()}
    assert both == {2, 4}


def test_breakdown_ties_by_first_appearance(spark):
    rows = [(9, "m", "A", "B"), (3, "m", "Z", "Y"), (4, "m", "A", "B"), (8, "m", "Z", "Y"), (1, "m", "C", "C"), (2, "m", None, "Q")]
    df = spark.createDataFrame(rows, "item_id long, model string, true_label string, pred_label string").repartition(3)
    pairs = E.pair_counts(df, first="item_id")
    got = [tuple(r) for r in E.error_breakdown(pairs, 10, ties="first").orderBy("rank").select("error_type", "n", "first").collect()]
    assert got == [("Z -> Y", 2, 3), ("A -> B", 2, 4), ("None -> Q", 1, 2)]
    assert [r["error_type"] for r in E.error_breakdown(pairs, 10).orderBy("rank").collect()] == ["A -> B", "Z -> Y", "None -> Q"]


def test_wide_matrix_is_one_aggregate_and_keeps_empty_classes(spark):
    from labelforge.functions.constants import LABEL_SCHEMA as S
    df = spark.createDataFrame([("m", S[0], S[1], 3), ("m", S[0], S[0], 2), ("m", S[2], "PARSING_ERROR", 9), ("m", "Else", S[0], 4)],
                               "model string, true_label string, pred_label string, n long")
    wide = E.confusion_wide(df)
    rows = {r["true_ord"]: r for r in wide.collect()}
    assert len(rows) == len(S) and (rows[0]["p0"], rows[0]["p1"], rows[0]["row_total"]) == (2, 3, 5) and rows[2]["row_total"] == 0
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_any_number_of_derived_labels(spark):
    from labelforge.operators import parsing as Rp
    labels = spark.range(100_000).select(F.concat(F.lit("L"), F.col("id").cast("string")).alias("label"))
    labels = labels.unionByName(labels.limit(5))                    # repeated labels join once
    df = spark.range(99_990, 100_010).select("id", F.concat(F.lit('{"label": "L'), F.col("id").cast("string"), F.lit('"}')).alias("response"))
    df = df.unionByName(spark.createDataFrame([(1, "no"), (2, None), (3, '{"label": "L3"}')], "id long, response string"))
    got = {r["id"]: (r["ok"], r["error_code"]) for r in Rp.parse_diagnostics(df, label_table=labels).collect()}
    assert len(got) == 23 and sum(ok for ok, _ in got.values()) == 11 and got[100_001] == (False, "INVALID_LABEL")
    assert got[1] == (False, "NO_JSON_FOUND") and got[2] == (False, "NO_RESPONSE") and got[3] == (True, None)


def test_label_usage_counts_zeros(spark):
    from labelforge.functions.constants import LABEL_SCHEMA as S
    from labelforge.operators import labels as L
    df = spark.createDataFrame([(f" {S[1]} ",), (S[1],), ("NONE",), (None,), ("Else",)], "label string")
    rows = L.label_usage(df).orderBy("label_ord").collect()
    assert [r["label"] for r in rows] == S and rows[1]["n"] == 2 and sum(r["n"] for r in rows) == 3
    assert [r["label"] for r in rows if not r["in_prompt"]] == ["NONE"] and all(r["in_prompt_with_none"] for r in rows)
