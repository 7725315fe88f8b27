"""Adapters that turn the driver tables into the workflow's record shapes.

* ``clauses``: labelled clause records from ``documents`` LEFT JOIN ``labels``.
* ``stub_responses``: deterministic model responses per clause, covering every
  response shape the parsers must handle (see ``STUB_SHAPES``).
* ``label_pairs``: (model, true_label, pred_label) rows derived from
  ``lineitem`` -- the high-volume input for metric jobs.

All rules are integer / string arithmetic that an SQL engine evaluates
identically, so the oracle SQL in ``labelforge.plans.oracle`` mirrors them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import LABEL_SCHEMA, PARSING_ERROR
from ..functions.text import py_strip
from .tables import read_table

MODELS = ["candidate", "baseline"]
MODEL_PATHS = {
    "candidate": "./gemma3-12b-legal-classifier",
    "baseline": "openrouter/deepseek/deepseek-r1-0528",
}
OUT_OF_SCHEMA_TRUTH = "Unlisted Clause"


SCHEMA_SQL = "array(" + ", ".join("'" + x.replace("'", "\\'") + "'" for x in LABEL_SCHEMA) + ")"


def schema_label_at(idx: Column) -> Column:
    """Schema label at 0-based ordinal ``idx``."""
    return F.element_at(F.expr(SCHEMA_SQL), (idx + 1).cast("int"))


def clauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    j = d.join(lab, "doc_id", "left")
    label = ("CASE WHEN quality IS NULL THEN (CASE WHEN doc_id % 11 = 0 THEN ' none ' "
             "WHEN doc_id % 13 = 0 THEN CAST(NULL AS STRING) ELSE 'NONE' END) "
             f"ELSE element_at({SCHEMA_SQL}, CAST((doc_id * 31 + quality * 5 + toxic) % 37 + 1 AS INT)) END")
    return j.selectExpr(
        "doc_id AS item_id",
        "CASE WHEN doc_id % 10 = 0 THEN 'test' WHEN doc_id % 10 = 1 THEN 'validation' ELSE 'train' END AS split",
        # the first line is the clause, the whole text its context, what follows the first
        # line the rationale: nothing of a text is left out
        "CASE WHEN doc_id % 5 = 0 THEN concat('  ', substring_index(text, '\\n', 1), '\\t') "
        "ELSE substring_index(text, '\\n', 1) END AS clause",
        "text AS clause_with_context",
        "CASE WHEN doc_id % 7 = 0 THEN CAST(NULL AS STRING) WHEN doc_id % 7 = 1 THEN '  ' "
        "ELSE upper(source) END AS contract_type",
        f"{label} AS label",
        "concat('Because ', substring(text, length(substring_index(text, '\\n', 1)) + 2)) AS rationale",
        # optional per-row generation settings (sparse on purpose)
        "CASE WHEN doc_id % 4 = 0 THEN 'deepseek/deepseek-r1-0528' END AS model",
        "CASE WHEN doc_id % 3 <> 0 THEN (doc_id % 10) / 10.0D END AS temperature",
        "CASE WHEN doc_id % 6 = 0 THEN 0.9D END AS top_p",
    )


def _obj(label: Column) -> Column:
    return F.concat(F.lit('{"rationale": "r", "label": "'), label, F.lit('"}'))


def stub_response(item_id: Column, label: Column, k: Column) -> Column:
    """Deterministic response of model ``k`` (0 candidate, 1 baseline)."""
    shape = (item_id * 17 + k * 5) % 22
    gold = F.coalesce(py_strip(label), F.lit("NONE"))
    wrong = schema_label_at((item_id * 7 + k) % 38)
    return (F.when(shape <= 4, _obj(gold))
            .when(shape <= 6, _obj(wrong))
            .when(shape == 7, F.concat(F.lit("```json\n"), _obj(gold), F.lit("\n```")))
            .when(shape == 8, F.concat(F.lit("Here is my analysis: "), _obj(gold), F.lit(" Hope this helps.")))
            .when(shape == 9, F.concat(F.lit('{"output": {"Category": "'), gold, F.lit('"}}')))
            .when(shape == 10, F.concat(F.lit('{"label": "'), gold, F.lit('"} trailing }')))
            .when(shape == 11, F.concat(F.lit("{'label': '"), gold, F.lit("'}")))
            .when(shape == 12, F.lit("no json here"))
            .when(shape == 13, F.lit(None).cast("string"))
            .when(shape == 14, F.lit('{"label": null}'))
            .when(shape == 15, F.lit('{"label": "Not A Label"}'))
            .when(shape == 16, F.concat(F.lit("["), _obj(gold), F.lit("] or ["), _obj(wrong), F.lit("]")))
            .when(shape == 17, F.concat(_obj(gold), F.lit('] junk [{"x": 1}')))
            .when(shape == 18, F.concat(_obj(gold), F.lit("]}")))
            .when(shape == 19, F.concat(_obj(gold), F.lit("][{}")))
            .when(shape == 20, F.concat(F.lit('{"label": "'), gold, F.lit('", "LABEL": "'), wrong, F.lit('"}')))
            .otherwise(F.concat(F.lit('{"LABEL": "'), wrong, F.lit('", "label": "'), gold, F.lit('"}'))))


def stub_responses(items: DataFrame) -> DataFrame:
    """(item_id, model, response): one row per item and model, one scan."""
    k = F.explode(F.array(F.lit(0), F.lit(1))).alias("k")
    x = items.select("item_id", "label", k)
    return x.select(
        "item_id",
        F.when(F.col("k") == 0, F.lit(MODELS[0])).otherwise(F.lit(MODELS[1])).alias("model"),
        stub_response(F.col("item_id"), F.col("label"), F.col("k")).alias("response"),
    )


def label_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, true_label, pred_label) rows derived from ``lineitem``."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    o, p, s, ln = (F.col(c) for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])
    t = (p * 7 + s) % 38
    truth = (F.when(o % 97 == 0, F.lit(OUT_OF_SCHEMA_TRUTH))
             .when(o % 101 == 0, F.lit(None).cast("string"))
             .otherwise(schema_label_at(t)))
    in_schema = (o % 97 != 0) & (o % 101 != 0)
    k = F.col("k")
    shape = (o * 13 + ln * 3 + p + k * 7) % 10
    pred = (F.when(shape <= 5, F.when(in_schema, schema_label_at(t)).otherwise(schema_label_at((t + k) % 38)))
            .when(shape <= 7, schema_label_at((p + o + k) % 38))
            .when(shape == 8, F.lit(PARSING_ERROR))
            .otherwise(schema_label_at((t + 1 + k) % 38)))
    x = li.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("k"))
    return x.select(
        F.when(k == 0, F.lit(MODELS[0])).otherwise(F.lit(MODELS[1])).alias("model"),
        truth.alias("true_label"),
        pred.alias("pred_label"),
    )
