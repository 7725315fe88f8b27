"""Response parsers as table jobs (R1-R3): response column in, label columns out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import jsonexpr as J
from ..functions.constants import (DIAG_DECODE, DIAG_INVALID, DIAG_MISSING, DIAG_NO_JSON,
                                   DIAG_NO_RESPONSE, PARSING_ERROR, RAW_SNIPPET_CHARS,
                                   SIMPLE_BAD_JSON, SIMPLE_DEFAULT, SIMPLE_NO_OBJECT,
                                   SIMPLE_NULL_INPUT)
from ..session import materialize
from .labels import valid_labels as _valid_labels

# A no-op guard that is non-deterministic: filters on parse results stay above
# it instead of being pushed down and inlining every stage (see text.plan_barrier).
BARRIER = "CASE WHEN spark_partition_id() < 0 THEN NULL ELSE {} END"
S, Q_ = J.sql_str, J.q


def parse_simple(df: DataFrame, response: str = "response") -> DataFrame:
    """(label, rationale) from the widest brace span; no fence handling.

    Missing keys -> 'N/A'; no span -> ('Parsing Error', raw); invalid JSON ->
    ('JSON Error', raw); null input -> the error text, null rationale.
    """
    x = J.with_brace_span(df, response, "_span")
    x = J.with_strict_json(x, "_span", "_v")
    r = Q_(response)
    label = (f"CASE WHEN {r} IS NULL THEN {S(SIMPLE_NULL_INPUT)} WHEN _span IS NULL THEN {S(SIMPLE_NO_OBJECT)} "
             f"WHEN _v IS NULL THEN {S(SIMPLE_BAD_JSON)} ELSE {J.field_as_text_sql('_v', 'label', SIMPLE_DEFAULT)} END")
    rationale = (f"CASE WHEN {r} IS NULL THEN CAST(NULL AS STRING) WHEN _span IS NULL OR _v IS NULL THEN {r} "
                 f"ELSE {J.field_as_text_sql('_v', 'rationale', SIMPLE_DEFAULT)} END")
    keep = [Q_(c) for c in df.columns if c not in ("label", "rationale")]
    return x.selectExpr(*keep, f"{BARRIER.format(label)} AS label", f"{BARRIER.format(rationale)} AS rationale")


def with_strict_label(df: DataFrame, response: str = "response", out: str = "label",
                      fence_mode: str = "pipeline") -> DataFrame:
    """R2: pipeline parser -- fence strip, brace span, strict JSON, then the
    stripped ``label`` when it is a string under that exact key, else null."""
    x = J.with_fences_stripped(df, response, "_clean", fence_mode)
    x = J.with_brace_span(x, "_clean", "_span")
    x = J.with_strict_json(x, "_span", "_v")
    keep = [Q_(c) for c in df.columns if c != out]
    lab = J.sql_strip(J.label_field_strict_sql("_v"))
    return x.selectExpr(*keep, f"{BARRIER.format(lab)} AS {Q_(out)}")


def parse_strict(df: DataFrame, response: str = "response", out: str = "label") -> DataFrame:
    return with_strict_label(df, response, out)


def parse_diagnostics(df: DataFrame, response: str = "response", labels: list[str] | None = None,
                      show_json_substring: bool = True, snippet: int = RAW_SNIPPET_CHARS,
                      fence_mode: str = "notebook", label_table: DataFrame | None = None) -> DataFrame:
    """Label or PARSING_ERROR plus diagnostics columns.

    Labels are valid when they are in ``labels`` (a list, by default the schema
    without NONE) or, if given, in ``label_table`` (column ``label``, for
    example the labels derived from the data, of any number).  The parse is then
    written once and joined to the table.

    Codes, first match wins: NO_RESPONSE, NO_JSON_FOUND, JSON_DECODE_ERROR,
    MISSING_LABEL_FIELD, INVALID_LABEL; ``ok`` otherwise.
    """
    labels = _valid_labels(False) if labels is None else labels
    r = Q_(response)
    x = df.selectExpr("*", f"{r} IS NULL OR {J.sql_strip(r)} = '' AS _blank")
    x = J.with_fences_stripped(x, response, "_clean", fence_mode)
    x = J.with_brace_span(x, "_clean", "_span")
    x = J.with_strict_json(x, "_span", "_v")
    x = J.with_coerced_label(x, "_v", "_raw", "_span")
    x = x.selectExpr("*", f"{J.sql_strip('_raw')} AS _norm")
    in_schema = "_norm IN (" + ", ".join(S(v) for v in labels) + ")" if labels else "false"
    # of the span only its first characters are used below, of the value only whether there is one
    x = x.selectExpr(*[Q_(c) for c in df.columns], "_blank", "_span IS NULL AS _no_span", f"substring(_span, 1, {snippet}) AS _sub",
                     "_v IS NULL AS _no_value", "_raw", "_norm")
    if label_table is not None:
        known = label_table.select(F.col("label").alias("_known")).distinct()
        x = materialize(x)
        x = x.join(known, x["_norm"] == known["_known"], "left")
        in_schema = "_known IS NOT NULL"
    stage = (f"CASE WHEN _blank THEN 0 WHEN _no_span THEN 1 WHEN _no_value THEN 2 "
             f"WHEN _raw IS NULL OR _norm = '' THEN 3 WHEN NOT ({in_schema}) THEN 4 ELSE 5 END")
    x = x.selectExpr("*", f"{BARRIER.format(stage)} AS _stage")
    code = (f"CASE _stage WHEN 0 THEN {S(DIAG_NO_RESPONSE[0])} WHEN 1 THEN {S(DIAG_NO_JSON[0])} "
            f"WHEN 2 THEN {S(DIAG_DECODE[0])} WHEN 3 THEN {S(DIAG_MISSING[0])} WHEN 4 THEN {S(DIAG_INVALID)} END")
    detail = (f"CASE _stage WHEN 0 THEN {S(DIAG_NO_RESPONSE[1])} WHEN 1 THEN {S(DIAG_NO_JSON[1])} "
              f"WHEN 2 THEN {S(DIAG_DECODE[1])} WHEN 3 THEN {S(DIAG_MISSING[1])} "
              f"WHEN 4 THEN concat('Label ''', _norm, ''' not in valid label set.') END")
    json_sub = "CASE WHEN _stage >= 2 THEN _sub END" if show_json_substring \
        else "CAST(NULL AS STRING)"
    return x.selectExpr(
        *[Q_(c) for c in df.columns],
        f"CASE WHEN _stage = 5 THEN _norm ELSE {S(PARSING_ERROR)} END AS pred_label",
        "_stage = 5 AS ok",
        f"{code} AS error_code",
        f"{detail} AS error_detail",
        f"substring(coalesce({r}, ''), 1, {snippet}) AS raw_snippet",
        f"{json_sub} AS json_substring",
        "CASE WHEN _stage >= 4 THEN _raw END AS parsed_label",
        "CASE WHEN _stage >= 4 THEN _norm END AS normalized_label",
    )

