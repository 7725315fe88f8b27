"""Response-parsing expressions: fences, brace span, strict JSON, label keys.

All of it is built from Catalyst functions (``locate``, ``substring``,
``try_parse_json`` / variant access), so parsing runs inside whole-stage
codegen with no Python worker round trip.

The steps are applied as successive projections (``with_*`` helpers) so every
step refers to the previous step's column; written as one nested expression
the shared sub-expressions would be copied many times over.  Each stage is one
``selectExpr`` of SQL expressions: a single driver-to-JVM call per stage
instead of one per column operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import apply_required_conf
from .constants import LABEL_KEY_NAMES, LABEL_KEY_WRAPPERS, PY_WHITESPACE
from .text import col_

FENCE = "```"
JSON_FENCE = "```json"

# Python's str.strip() set as a Spark SQL literal (\\uXXXX escapes).
WS_SQL = "'" + "".join(f"\\u{ord(c):04X}" for c in PY_WHITESPACE) + "'"


def sql_str(s: str) -> str:
    """Spark SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_strip(e: str) -> str:
    return f"btrim({e}, {WS_SQL})"


def _stage(df: DataFrame, **cols: str) -> DataFrame:
    return df.selectExpr("*", *[f"{e} AS {q(n)}" for n, e in cols.items()])


def with_fences_stripped(df: DataFrame, src: str, out: str, mode: str = "notebook") -> DataFrame:
    """Remove a markdown code fence around the JSON payload (R4a pipeline, R4b notebook).

    ``mode="notebook"``: a ```json fence is used when closed (an empty one
    gives ''); otherwise, or with no json fence, the first generic fence pair.
    ``mode="pipeline"``: a ```json fence is used only when its body is
    non-empty; when the json marker is present the generic branch is skipped;
    the generic branch needs a ``{`` somewhere in the text.
    Null stays null.
    """
    t = q(src)
    jl, gl = len(JSON_FENCE), len(FENCE)
    x = _stage(df, _js=f"locate('{JSON_FENCE}', {t})", _gs=f"locate('{FENCE}', {t})")
    x = _stage(x, _je=f"CASE WHEN _js > 0 THEN locate('{FENCE}', {t}, _js + {jl}) ELSE 0 END",
               _ge=f"CASE WHEN _gs > 0 THEN locate('{FENCE}', {t}, _gs + {gl}) ELSE 0 END")
    json_part = sql_strip(f"substring({t}, _js + {jl}, _je - _js - {jl})")
    gen_part = sql_strip(f"substring({t}, _gs + {gl}, _ge - _gs - {gl})")
    if mode == "notebook":
        e = (f"CASE WHEN {t} IS NULL THEN {t} WHEN _js > 0 AND _je > 0 THEN {json_part} "
             f"WHEN _gs > 0 AND _ge > 0 THEN {gen_part} ELSE {t} END")
    elif mode == "pipeline":
        e = (f"CASE WHEN {t} IS NULL THEN {t} "
             f"WHEN _js > 0 THEN (CASE WHEN _je > _js + {jl} THEN {json_part} ELSE {t} END) "
             f"WHEN _gs > 0 AND locate('{{', {t}) > 0 AND _ge > _gs + {gl} THEN {gen_part} ELSE {t} END")
    else:
        raise ValueError(f"unknown fence mode {mode!r}")
    return _stage(x, **{out: e}).drop("_js", "_gs", "_je", "_ge")


def with_brace_span(df: DataFrame, src: str, out: str) -> DataFrame:
    """Widest ``{...}`` substring (first ``{`` to last ``}``), or null."""
    t = q(src)
    x = _stage(df, _bs=f"locate('{{', {t})",
               _be=f"CASE WHEN instr(reverse({t}), '}}') > 0 THEN length({t}) - instr(reverse({t}), '}}') + 1 ELSE 0 END")
    x = _stage(x, **{out: f"CASE WHEN _bs > 0 AND _be > _bs THEN substring({t}, _bs, _be - _bs + 1) END"})
    return x.drop("_bs", "_be")


def strict_json_ok(c) -> Column:
    """True when ``c`` is exactly one JSON value under a strict parser.

    ``try_parse_json`` tolerates trailing content, also after a text that closes
    the wrapper itself.  So the text must parse both as the only element of
    ``[...]`` and as the value in ``{"w":...}``: what closes one wrapper early
    is invalid in the other.  Null input gives null.
    """
    arr = F.try_parse_json(F.concat(F.lit("["), col_(c), F.lit("]")))
    obj = F.try_parse_json(F.concat(F.lit('{"w":'), col_(c), F.lit("}")))
    return arr.isNotNull() & F.try_variant_get(arr, "$[1]", "variant").isNull() & obj.isNotNull()


def with_strict_json(df: DataFrame, src: str, out: str) -> DataFrame:
    """VARIANT of a strictly valid JSON text, else null (see ``strict_json_ok``).
    Duplicate keys are valid, the last one counts: the session setting that this
    needs is made here."""
    apply_required_conf(df.sparkSession)
    x = _stage(df, _arr=f"try_parse_json('[' || {q(src)} || ']')", _obj=f"try_parse_json('{{\"w\":' || {q(src)} || '}}')")
    x = _stage(x, **{out: "CASE WHEN try_variant_get(_arr, '$[1]', 'variant') IS NULL AND _obj IS NOT NULL "
                          "THEN try_variant_get(_arr, '$[0]', 'variant') END"})
    return x.drop("_arr", "_obj")


def variant_text_sql(v: str) -> str:
    """Strings as is, booleans as ``True``/``False``, other values as JSON text."""
    return (f"CASE WHEN {v} IS NULL OR is_variant_null({v}) THEN CAST(NULL AS STRING) "
            f"WHEN schema_of_variant({v}) = 'STRING' THEN variant_get({v}, '$', 'string') "
            f"WHEN schema_of_variant({v}) = 'BOOLEAN' THEN "
            f"(CASE WHEN variant_get({v}, '$', 'boolean') THEN 'True' ELSE 'False' END) "
            f"ELSE to_json({v}) END")


def with_coerced_label(df: DataFrame, src: str, out: str, text: str) -> DataFrame:
    """Label value from a parsed object: root first, then dict-valued wrappers
    (``output``, ``response``, ``data``, ``result``).

    In each candidate the first of ``label``, ``category``, ``class``,
    ``prediction`` present (any case) decides; the first candidate holding one
    ends the search, and a JSON null there gives null.  Of several case variants
    of a key the last in the document wins: a VARIANT sorts its keys, so their
    order is read from ``text``, the column ``src`` was parsed from, and only in
    rows that hold several.  Non-strings are rendered as text.  ``out`` is null
    when no candidate holds a key.
    """
    names = ["_m0"] + [f"_m{i + 1}" for i in range(len(LABEL_KEY_WRAPPERS))]
    texts = [q(text)] + [f"get_json_object({q(text)}, '$.{w}')" for w in LABEL_KEY_WRAPPERS]

    def keyed(df_: DataFrame, m: str, t: str) -> DataFrame:
        hits = []
        for n in LABEL_KEY_NAMES:
            own = f"filter(map_keys({m}), k -> lower(k) = '{n}')"
            in_order = f"element_at(filter(json_object_keys({t}), k -> lower(k) = '{n}'), -1)"
            hits.append(f"CASE WHEN size({own}) > 1 THEN {in_order} WHEN size({own}) = 1 THEN element_at({own}, 1) END")
        return _stage(df_, **{f"_k{m}": "coalesce(" + ", ".join(hits) + ")"})

    x = _stage(df, _m0=f"try_variant_get({q(src)}, '$', 'map<string,variant>')")
    x = keyed(x, "_m0", texts[0])
    # wrappers are only looked at when the root holds no label key
    x = _stage(x, **{names[i + 1]: f"CASE WHEN _k_m0 IS NULL THEN "
                                   f"try_variant_get(try_element_at(_m0, '{w}'), '$', 'map<string,variant>') END"
                     for i, w in enumerate(LABEL_KEY_WRAPPERS)})
    for m, t in zip(names[1:], texts[1:]):
        x = keyed(x, m, t)
    pick = "CASE " + " ".join(f"WHEN _k{m} IS NOT NULL THEN try_element_at({m}, _k{m})" for m in names) + " END"
    found = "coalesce(" + ", ".join(f"_k{m}" for m in names) + ") IS NOT NULL"
    x = _stage(x, _lv=pick, _found=found)
    x = _stage(x, **{out: f"CASE WHEN _found THEN {variant_text_sql('_lv')} END"})
    return x.drop(*names, *[f"_k{m}" for m in names], "_lv", "_found")


def label_field_strict_sql(v: str) -> str:
    """Top-level ``label`` when it is a JSON string, else null."""
    lab = f"try_variant_get({v}, '$.label', 'variant')"
    return f"CASE WHEN schema_of_variant({lab}) = 'STRING' THEN variant_get({lab}, '$', 'string') END"


def field_as_text_sql(v: str, key: str, default: str) -> str:
    """``obj.get(key, default)`` rendered as text: missing -> default, null -> null."""
    val = f"try_variant_get({v}, '$.{key}', 'variant')"
    return f"CASE WHEN {val} IS NULL THEN {sql_str(default)} ELSE {variant_text_sql(val)} END"
