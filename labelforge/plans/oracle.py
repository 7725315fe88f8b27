"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark code from the same rules (fixture
arithmetic, parser semantics, metric definitions).  Tables are the driver's
pre-registered views.  Shared CTEs are composed from the pieces below.
"""

from __future__ import annotations

import json

from ..functions.constants import (CLASSIFY_INSTRUCTIONS, CLASSIFY_TASK, FEW_SHOT, LABEL_SCHEMA,
                                   PY_WHITESPACE, RATIONALE_PROMPT_TEMPLATE, SCHEMA_LABEL_DESC,
                                   SCHEMA_RATIONALE_DESC, TEACHER_SYSTEM)


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


WS = "(" + "||".join(f"chr({ord(c)})" for c in PY_WHITESPACE) + ")"
NL = "chr(10)"
SCHEMA = "[" + ", ".join(q(x) for x in LABEL_SCHEMA) + "]"
NON_NONE = "[" + ", ".join(q(x) for x in LABEL_SCHEMA if x != "NONE") + "]"
MODELS = "(VALUES (0, 'candidate'), (1, 'baseline')) m(k, model)"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def strip0(x: str) -> str:
    return f"trim(coalesce({x}, ''), {WS})"


def jesc(x: str) -> str:
    return f"CAST(to_json({x}) AS VARCHAR)"


def lit_nl(s: str) -> str:
    """String literal with newlines as chr(10) pieces."""
    parts = s.split("\n")
    return f" || {NL} || ".join(q(p) for p in parts)


CLAUSES = f"""clauses AS (
  SELECT d.doc_id AS item_id,
    CASE WHEN d.doc_id % 10 = 0 THEN 'test' WHEN d.doc_id % 10 = 1 THEN 'validation' ELSE 'train' END AS split,
    CASE WHEN d.doc_id % 5 = 0 THEN '  ' || string_split(d.text, chr(10))[1] || chr(9)
         ELSE string_split(d.text, chr(10))[1] END AS clause,
    d.text AS clause_with_context,
    CASE WHEN d.doc_id % 7 = 0 THEN NULL WHEN d.doc_id % 7 = 1 THEN '  ' ELSE upper(d.source) END AS contract_type,
    CASE WHEN l.doc_id IS NULL THEN
           (CASE WHEN d.doc_id % 11 = 0 THEN ' none ' WHEN d.doc_id % 13 = 0 THEN NULL ELSE 'NONE' END)
         ELSE {SCHEMA}[((d.doc_id * 31 + l.quality * 5 + l.toxic) % 37) + 1] END AS label,
    'Because ' || substring(d.text, length(string_split(d.text, chr(10))[1]) + 2) AS rationale,
    CASE WHEN d.doc_id % 4 = 0 THEN 'deepseek/deepseek-r1-0528' END AS model,
    CASE WHEN d.doc_id % 3 <> 0 THEN CAST(d.doc_id % 10 AS DOUBLE) / 10.0 END AS temperature,
    CASE WHEN d.doc_id % 6 = 0 THEN CAST(0.9 AS DOUBLE) END AS top_p
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def _obj(g: str) -> str:
    return f"""'{{"rationale": "r", "label": "' || {g} || '"}}'"""


RESPONSES = f"""resp_base AS (
  SELECT c.item_id, m.k, m.model, (c.item_id * 17 + m.k * 5) % 22 AS shape,
    coalesce({strip('c.label')}, 'NONE') AS g, {SCHEMA}[((c.item_id * 7 + m.k) % 38) + 1] AS w
  FROM clauses c CROSS JOIN {MODELS}),
responses AS (
  SELECT item_id, model, CASE
    WHEN shape <= 4 THEN {_obj('g')}
    WHEN shape <= 6 THEN {_obj('w')}
    WHEN shape = 7 THEN '```json' || {NL} || {_obj('g')} || {NL} || '```'
    WHEN shape = 8 THEN 'Here is my analysis: ' || {_obj('g')} || ' Hope this helps.'
    WHEN shape = 9 THEN '{{"output": {{"Category": "' || g || '"}}}}'
    WHEN shape = 10 THEN '{{"label": "' || g || '"}} trailing }}'
    WHEN shape = 11 THEN '{{''label'': ''' || g || '''}}'
    WHEN shape = 12 THEN 'no json here'
    WHEN shape = 13 THEN NULL
    WHEN shape = 14 THEN '{{"label": null}}'
    WHEN shape = 15 THEN '{{"label": "Not A Label"}}'
    WHEN shape = 16 THEN '[' || {_obj('g')} || '] or [' || {_obj('w')} || ']'
    WHEN shape = 17 THEN {_obj('g')} || '] junk [{{"x": 1}}'
    WHEN shape = 18 THEN {_obj('g')} || ']}}'
    WHEN shape = 19 THEN {_obj('g')} || '][{{}}'
    WHEN shape = 20 THEN '{{"label": "' || g || '", "LABEL": "' || w || '"}}'
    ELSE '{{"LABEL": "' || w || '", "label": "' || g || '"}}' END AS response
  FROM resp_base)"""


def parse_ctes(src: str, prefix: str, mode: str | None) -> str:
    """CTEs <prefix>_c (clean), <prefix>_s (span, v).  Input ``src`` has column ``r``."""
    if mode is None:
        clean = "r"
    elif mode == "notebook":
        clean = f"""CASE WHEN r IS NULL THEN NULL
        WHEN js > 0 AND je > 0 THEN {strip('substring(r, js + 7, je - (js + 7))')}
        WHEN gs > 0 AND ge > 0 THEN {strip('substring(r, gs + 3, ge - (gs + 3))')}
        ELSE r END"""
    else:
        clean = f"""CASE WHEN r IS NULL THEN NULL
        WHEN js > 0 THEN (CASE WHEN je > js + 7 THEN {strip('substring(r, js + 7, je - (js + 7))')} ELSE r END)
        WHEN gs > 0 AND strpos(r, '{{') > 0 AND ge > gs + 3 THEN {strip('substring(r, gs + 3, ge - (gs + 3))')}
        ELSE r END"""
    return f"""{prefix}_f AS (
  SELECT *, CASE WHEN js > 0 AND strpos(substring(r, js + 7), '```') > 0
                 THEN js + 6 + strpos(substring(r, js + 7), '```') ELSE 0 END AS je,
            CASE WHEN gs > 0 AND strpos(substring(r, gs + 3), '```') > 0
                 THEN gs + 2 + strpos(substring(r, gs + 3), '```') ELSE 0 END AS ge
  FROM (SELECT *, strpos(r, '```json') AS js, strpos(r, '```') AS gs FROM {src})),
{prefix}_c AS (SELECT *, {clean} AS clean FROM {prefix}_f),
{prefix}_b AS (SELECT *, strpos(clean, '{{') AS bs,
    CASE WHEN strpos(reverse(clean), '}}') > 0 THEN length(clean) - strpos(reverse(clean), '}}') + 1 ELSE 0 END AS be
  FROM {prefix}_c),
{prefix}_s AS (SELECT *, CASE WHEN bs > 0 AND be > bs THEN substring(clean, bs, be - bs + 1) END AS span FROM {prefix}_b),
{prefix}_v AS (SELECT *, CASE WHEN json_valid(span) THEN CAST(span AS JSON) END AS v FROM {prefix}_s)"""


def text_of(j: str) -> str:
    """JSON value -> text: null -> NULL, string as is, bool True/False, else JSON text."""
    return f"""(CASE WHEN {j} IS NULL OR json_type({j}) = 'NULL' THEN NULL
      WHEN json_type({j}) = 'VARCHAR' THEN json_extract_string({j}, '$')
      WHEN json_type({j}) = 'BOOLEAN' THEN (CASE WHEN CAST({j} AS VARCHAR) = 'true' THEN 'True' ELSE 'False' END)
      ELSE CAST({j} AS VARCHAR) END)"""


def field_text(v: str, key: str, default: str) -> str:
    j = f"json_extract({v}, '$.{key}')"
    return f"(CASE WHEN json_type({v}, '$.{key}') IS NULL THEN {q(default)} ELSE {text_of(j)} END)"


WRAPPERS = ["output", "response", "data", "result"]
KEYNAMES = ["label", "category", "class", "prediction"]


def coerce_ctes(prefix: str) -> str:
    ms = ", ".join(f"CASE WHEN json_type(v, '$.{w}') = 'OBJECT' THEN json_extract(v, '$.{w}') END AS m{i + 1}"
                   for i, w in enumerate(WRAPPERS))
    keys = ", ".join(
        "coalesce(" + ", ".join(f"list_filter(json_keys(m{i}), lambda x: lower(x) = '{n}')[-1]" for n in KEYNAMES)
        + f") AS k{i}" for i in range(5))
    pick = " ".join(f"WHEN k{i} IS NOT NULL THEN json_extract(m{i}, '$.\"' || k{i} || '\"')" for i in range(5))
    return f"""{prefix}_m AS (SELECT *, v AS m0, {ms} FROM {prefix}_v),
{prefix}_k AS (SELECT *, {keys} FROM {prefix}_m),
{prefix}_l AS (SELECT *, CASE {pick} END AS lv, coalesce(k0, k1, k2, k3, k4) IS NOT NULL AS found FROM {prefix}_k),
{prefix}_r AS (SELECT *, CASE WHEN found THEN {text_of('lv')} END AS raw FROM {prefix}_l),
{prefix}_n AS (SELECT *, {strip('raw')} AS norm,
    CASE WHEN r IS NULL OR {strip('r')} = '' THEN 0 WHEN span IS NULL THEN 1 WHEN v IS NULL THEN 2
         WHEN raw IS NULL OR {strip('raw')} = '' THEN 3 WHEN NOT list_contains({NON_NONE}, {strip('raw')}) THEN 4
         ELSE 5 END AS st
  FROM {prefix}_r)"""


DIAG_COLS = f"""CASE WHEN st = 5 THEN norm ELSE 'PARSING_ERROR' END AS pred_label, st = 5 AS ok,
  CASE st WHEN 0 THEN 'NO_RESPONSE' WHEN 1 THEN 'NO_JSON_FOUND' WHEN 2 THEN 'JSON_DECODE_ERROR'
          WHEN 3 THEN 'MISSING_LABEL_FIELD' WHEN 4 THEN 'INVALID_LABEL' END AS error_code,
  CASE st WHEN 0 THEN 'Model returned empty response.' WHEN 1 THEN 'Could not find brace-delimited JSON in response.'
          WHEN 2 THEN 'JSONDecodeError: invalid JSON' WHEN 3 THEN 'Parsed JSON but no usable ''label'' found.'
          WHEN 4 THEN 'Label ''' || norm || ''' not in valid label set.' END AS error_detail,
  substring(coalesce(r, ''), 1, 600) AS raw_snippet,
  CASE WHEN st >= 2 THEN substring(span, 1, 600) END AS json_substring,
  CASE WHEN st >= 4 THEN raw END AS parsed_label,
  CASE WHEN st >= 4 THEN norm END AS normalized_label"""

DIAG = (RESPONSES + ",\nrd_src AS (SELECT item_id, model, response AS r FROM responses),\n"
        + parse_ctes("rd_src", "rd", "notebook") + ",\n" + coerce_ctes("rd")
        + f""",
diag AS (SELECT n.item_id, n.model, {DIAG_COLS}, {strip0('c.label')} AS true_label
  FROM rd_n n JOIN clauses c ON n.item_id = c.item_id)""")

PREDS = (RESPONSES + ",\nrp_src AS (SELECT item_id, model, response AS r FROM responses),\n"
         + parse_ctes("rp_src", "rp", "pipeline") + f""",
rp_l AS (SELECT item_id, model, r,
    CASE WHEN json_type(v, '$.label') = 'VARCHAR' THEN {strip("json_extract_string(v, '$.label')")} END AS lab FROM rp_v),
preds AS (
  SELECT c.item_id, m.model, c.label AS true_label,
    coalesce(CASE WHEN list_contains({SCHEMA}, p.lab) THEN p.lab END, 'PARSING_ERROR') AS pred_label,
    coalesce(CASE WHEN length(p.r) > 500 THEN substring(p.r, 1, 500) || '...' ELSE p.r END, '') AS response
  FROM clauses c CROSS JOIN {MODELS} LEFT JOIN rp_l p ON p.item_id = c.item_id AND p.model = m.model)""")

LP = f"""lp AS (
  SELECT model,
    CASE WHEN l_orderkey % 97 = 0 THEN 'Unlisted Clause' WHEN l_orderkey % 101 = 0 THEN NULL ELSE {SCHEMA}[t + 1] END AS true_label,
    CASE WHEN sh <= 5 THEN (CASE WHEN ins THEN {SCHEMA}[t + 1] ELSE {SCHEMA}[((t + k) % 38) + 1] END)
         WHEN sh <= 7 THEN {SCHEMA}[((l_partkey + l_orderkey + k) % 38) + 1]
         WHEN sh = 8 THEN 'PARSING_ERROR'
         ELSE {SCHEMA}[((t + 1 + k) % 38) + 1] END AS pred_label
  FROM (SELECT l_orderkey, l_partkey, m.k, m.model, (l_partkey * 7 + l_suppkey) % 38 AS t,
               (l_orderkey % 97 <> 0 AND l_orderkey % 101 <> 0) AS ins,
               (l_orderkey * 13 + l_linenumber * 3 + l_partkey + m.k * 7) % 10 AS sh
        FROM lineitem CROSS JOIN {MODELS})),
pc AS (SELECT model, true_label, pred_label, count(*) AS n FROM lp GROUP BY ALL)"""

SCH = f"""sch AS (SELECT unnest({SCHEMA}) AS label, CAST(generate_subscripts({SCHEMA}, 1) - 1 AS INTEGER) AS label_ord)"""


def metric_ctes(pairs: str) -> str:
    """CTEs over a pair-count relation ``pairs`` (model, true_label, pred_label, n)."""
    return f"""{SCH},
v AS (SELECT * FROM {pairs} WHERE pred_label IS DISTINCT FROM 'PARSING_ERROR'),
models AS (SELECT DISTINCT model FROM {pairs}),
bt AS (SELECT model, true_label AS label, sum(n) AS support,
              sum(CASE WHEN pred_label = true_label THEN n ELSE 0 END) AS tp FROM v GROUP BY ALL),
bp AS (SELECT model, pred_label AS label, sum(n) AS predicted FROM v GROUP BY ALL),
pcl0 AS (SELECT m.model, s.label_ord, s.label, CAST(coalesce(bt.tp, 0) AS BIGINT) AS tp,
           CAST(coalesce(bp.predicted, 0) AS BIGINT) AS predicted, CAST(coalesce(bt.support, 0) AS BIGINT) AS support
         FROM models m CROSS JOIN sch s LEFT JOIN bt ON bt.model = m.model AND bt.label = s.label
         LEFT JOIN bp ON bp.model = m.model AND bp.label = s.label),
pcl AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
           CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall,
           CASE WHEN support + predicted > 0 THEN 2 * tp / (support + predicted) ELSE 0.0 END AS f1 FROM pcl0),
sb AS (SELECT model, sum(n) AS total, sum(CASE WHEN pred_label IS NOT DISTINCT FROM true_label THEN n ELSE 0 END) AS correct,
         sum(CASE WHEN true_label IS DISTINCT FROM 'NONE' THEN n ELSE 0 END) AS nn_total,
         sum(CASE WHEN true_label IS DISTINCT FROM 'NONE' AND pred_label IS NOT DISTINCT FROM true_label THEN n ELSE 0 END) AS nn_correct,
         sum(CASE WHEN pred_label IS NOT DISTINCT FROM 'PARSING_ERROR' THEN n ELSE 0 END) AS pe
       FROM {pairs} GROUP BY model),
sw AS (SELECT model, sum(support) AS sup, sum(precision * support) AS wp, sum(recall * support) AS wr,
         sum(f1 * support) AS wf FROM pcl GROUP BY model),
summ AS (SELECT sb.model,
    round(CASE WHEN total > 0 THEN correct / total ELSE 0.0 END, 6) AS accuracy,
    CAST(correct AS BIGINT) AS correct_count, CAST(total AS BIGINT) AS total_count,
    round(CASE WHEN nn_total > 0 THEN nn_correct / nn_total ELSE 0.0 END, 6) AS non_none_accuracy,
    CAST(nn_correct AS BIGINT) AS non_none_correct_count, CAST(nn_total AS BIGINT) AS non_none_total_count,
    CAST(total - pe AS BIGINT) AS valid_predictions_count, CAST(pe AS BIGINT) AS parsing_errors_count,
    round(CASE WHEN sup > 0 THEN wp / sup ELSE 0.0 END, 6) AS precision,
    round(CASE WHEN sup > 0 THEN wr / sup ELSE 0.0 END, 6) AS recall,
    round(CASE WHEN sup > 0 THEN wf / sup ELSE 0.0 END, 6) AS f1_score
  FROM sb LEFT JOIN sw ON sb.model = sw.model)"""


def classify_prompt(labels: list[str], default: str, src: str = "") -> str:
    head = ('{"task": ' + json.dumps(CLASSIFY_TASK) + ', "instructions": ' + json.dumps(CLASSIFY_INSTRUCTIONS)
            + ', "schema": {"rationale": ' + json.dumps(SCHEMA_RATIONALE_DESC) + ', "label": '
            + json.dumps(SCHEMA_LABEL_DESC) + '}, "valid_labels": ' + json.dumps(labels, ensure_ascii=False)
            + ', "inputs": {"clause": ')
    ct = strip0(f"{src}contract_type")
    return (f"{q(head)} || {jesc(strip0(src + 'clause'))} || ', \"clause_with_context\": ' || "
            f"{jesc(strip0(src + 'clause_with_context'))} || ', \"contract_type\": ' || "
            f"{jesc(f'CASE WHEN {ct} = {chr(39)}{chr(39)} THEN {q(default)} ELSE {ct} END')} || '}}}}'")


NN_LIST = [x for x in LABEL_SCHEMA if x != "NONE"]
PROMPT_TRAIN = classify_prompt(NN_LIST, "")
PROMPT_NB_INFER = classify_prompt(NN_LIST, "Unknown")
TARGET = (f"""'{{"rationale": ' || {jesc(strip0('rationale'))} || ', "label": ' || """
          f"""{jesc(f"CASE WHEN label IS NULL OR label = '' THEN 'NONE' ELSE {strip('label')} END")} || '}}'""")
LOOSE = f"upper({strip0('label')}) <> 'NONE'"
USER_P = f"'<start_of_turn>user' || {NL}"
MODEL_P = f"'<start_of_turn>model' || {NL}"
EOT = f"'<end_of_turn>' || {NL}"


def rationale_prompt() -> str:
    import re
    parts = re.split(r"\{(\w+)\}", RATIONALE_PROMPT_TEMPLATE)
    out = []
    for i, p in enumerate(parts):
        if i % 2 == 0:
            if p:
                out.append(lit_nl(p))
        else:
            out.append(f"coalesce({p}, '')")
    return " || ".join(out)


CONV_PIECES = f"""ct AS (SELECT conv_id, turn, role, text,
    first_value(role) OVER w AS first_role, first_value(text) OVER w AS first_text,
    row_number() OVER w AS rn
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
cp AS (SELECT conv_id, turn, role, rn - (CASE WHEN first_role = 'system' THEN 2 ELSE 1 END) AS li,
    CASE WHEN role = 'user' THEN {USER_P} WHEN role IN ('assistant', 'model') THEN {MODEL_P}
         ELSE '<start_of_turn>' || role || {NL} END AS pre,
    CASE WHEN first_role = 'system' AND rn = 2 THEN {strip0('first_text')} || {NL} || {NL} ELSE '' END AS lead,
    {strip0('text')} AS body
  FROM ct WHERE NOT (first_role = 'system' AND rn = 1)),
cq AS (SELECT *, pre || lead || body || {EOT} AS piece FROM cp)"""

ORACLE_SQL: dict[str, str] = {}
W = "WITH " + CLAUSES

ORACLE_SQL.update({
    # ---------------- F
    "corpus_normalize": f"""{W} SELECT item_id, split, {strip0('clause')} AS clause,
        {strip0('clause_with_context')} AS clause_with_context, {strip0('contract_type')} AS contract_type,
        {strip('label')} AS label, {strip0('rationale')} AS rationale,
        CASE WHEN {strip0('contract_type')} = '' THEN 'Unknown' ELSE {strip0('contract_type')} END AS contract_type_or_unknown
        FROM clauses""",
    "corpus_none_loose": f"{W} SELECT item_id, split, label FROM clauses WHERE {LOOSE}",
    "corpus_none_exact": f"{W} SELECT item_id, split, label FROM clauses WHERE label IS DISTINCT FROM 'NONE'",
    "corpus_none_counts": f"""{W} SELECT 'exact' AS mode, count(*) AS total,
          count(*) FILTER (WHERE label IS NOT DISTINCT FROM 'NONE') AS excluded,
          count(*) FILTER (WHERE label IS DISTINCT FROM 'NONE') AS kept FROM clauses
        UNION ALL SELECT 'loose', count(*), count(*) FILTER (WHERE NOT ({LOOSE})),
          count(*) FILTER (WHERE {LOOSE}) FROM clauses""",
    "corpus_cap": f"""{W} SELECT item_id, split, label FROM (
        SELECT *, row_number() OVER (PARTITION BY split ORDER BY item_id) AS rn FROM clauses WHERE {LOOSE})
        WHERE rn <= 100""",
    "corpus_truncate": """SELECT doc_id AS item_id,
        CASE WHEN length(text) > 500 THEN substring(text, 1, 500) || '...' ELSE coalesce(text, '') END AS text_500,
        CAST(length(text) AS BIGINT) AS n_chars FROM documents""",
    "corpus_preview": f"{W} SELECT item_id, split, clause, contract_type, label FROM clauses WHERE item_id = 7",
    # ---------------- P
    "shuffle_key": f"{W} SELECT item_id, md5('42:' || CAST(item_id AS VARCHAR)) AS shuffle_key FROM clauses",
    "sample_eval": f"""{W} SELECT item_id, label, md5('42:' || CAST(item_id AS VARCHAR)) AS shuffle_key
        FROM clauses WHERE split = 'test' AND label IS DISTINCT FROM 'NONE'
        ORDER BY shuffle_key, item_id LIMIT 50""",
    "sample_eval_loose": f"""{W} SELECT item_id, label, md5('42:' || CAST(item_id AS VARCHAR)) AS shuffle_key
        FROM clauses WHERE split = 'test' AND {LOOSE} ORDER BY shuffle_key, item_id LIMIT 5""",
    "split_hash": f"""{W} SELECT item_id, CASE WHEN md5('42:' || CAST(item_id AS VARCHAR)) < '19999999999999999999999999999999'
        THEN 'validation' ELSE 'train' END AS role FROM clauses""",
    "split_exact": f"""{W} SELECT item_id, CASE WHEN rn <= ceil(CAST(0.1 AS DOUBLE) * n) THEN 'validation' ELSE 'train' END AS role
        FROM (SELECT item_id, row_number() OVER (ORDER BY md5('42:' || CAST(item_id AS VARCHAR)), item_id) AS rn,
                     count(*) OVER () AS n FROM clauses)""",
    "split_resolve": f"""{W}, f AS (SELECT bool_or(split = 'train') AS t, bool_or(split = 'validation') AS va,
          bool_or(split = 'val') AS vl, bool_or(split = 'test') AS te FROM clauses)
        SELECT item_id, split, CASE WHEN split = 'train' THEN 'train' ELSE 'validation' END AS role
        FROM clauses, f WHERE f.t AND split IN ('train',
          CASE WHEN f.va THEN 'validation' WHEN f.vl THEN 'val' WHEN f.te THEN 'test' END)""",
    # ---------------- L
    "labels_derived": f"""{W} SELECT DISTINCT {strip0('label')} AS label FROM clauses
        WHERE split = 'test' AND {strip0('label')} <> '' AND upper({strip0('label')}) <> 'NONE'""",
    "labels_used": f"""WITH {LP}, {SCH},
        seen AS (SELECT true_label AS label FROM pc UNION SELECT pred_label FROM pc),
        used AS (SELECT label, label_ord FROM sch WHERE label IN (SELECT label FROM seen WHERE label IS NOT NULL)
                 UNION ALL SELECT 'PARSING_ERROR', 1000000 WHERE EXISTS (SELECT 1 FROM pc WHERE pred_label = 'PARSING_ERROR'))
        SELECT CAST(row_number() OVER (ORDER BY label_ord) - 1 AS INTEGER) AS class_ord, label FROM used""",
    "labels_validate": f"""{W} SELECT item_id, {strip0('label')} AS label,
        CASE WHEN list_contains({SCHEMA}, {strip0('label')}) THEN {strip0('label')} END AS valid_label FROM clauses""",
    # ---------------- T
    "prompt_classify": f"{W} SELECT item_id, {PROMPT_TRAIN} AS prompt FROM clauses",
    "prompt_classify_nb": f"{W} SELECT item_id, {classify_prompt(LABEL_SCHEMA, 'Unknown')} AS prompt FROM clauses",
    "prompt_rationale": f"{W} SELECT item_id, {rationale_prompt()} AS prompt FROM clauses",
    "teacher_messages": f"""{W}, msgs AS (SELECT * FROM (VALUES (0, 'system', {q(TEACHER_SYSTEM)}),
          {", ".join(f"({i + 1}, {q(r)}, {q(c)})" for i, (r, c) in enumerate(FEW_SHOT))},
          (5, 'user', NULL)) t(msg_index, role, content))
        SELECT c.item_id, CAST(m.msg_index AS INTEGER) AS msg_index, m.role,
          CASE WHEN m.msg_index = 5 THEN {classify_prompt(NN_LIST, 'Unknown', src='c.')} ELSE m.content END AS content
        FROM clauses c CROSS JOIN msgs m""",
    "sft_target": f"{W} SELECT item_id, {TARGET} AS target FROM clauses",
    "conversation_record": f"""{W} SELECT item_id, 0 AS turn, 'user' AS role, 'text' AS content_type, {PROMPT_TRAIN} AS text
          FROM clauses WHERE {LOOSE}
        UNION ALL SELECT item_id, 1, 'assistant', 'text', {TARGET} FROM clauses WHERE {LOOSE}""",
    "sft_text": f"""{W} SELECT item_id, '<bos>' || {USER_P} || {strip(PROMPT_TRAIN)} || {EOT} || {MODEL_P} || {strip(TARGET)} || {EOT} AS text
        FROM clauses WHERE {LOOSE}""",
    "infer_text": f"""{W} SELECT item_id, '<bos>' || {USER_P} || {strip(PROMPT_NB_INFER)} || {EOT} || {MODEL_P} AS text FROM clauses""",
    "chat_text": f"""WITH {CONV_PIECES}
        SELECT conv_id, '<bos>' || coalesce(string_agg(piece, '' ORDER BY turn), '') AS text,
          bool_and((role = 'user') = (li % 2 = 0)) AS roles_ok FROM cq GROUP BY conv_id""",
    "loss_spans": f"""WITH {CONV_PIECES},
        co AS (SELECT *, 5 + coalesce(sum(length(piece)) OVER (PARTITION BY conv_id ORDER BY turn
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM cq)
        SELECT conv_id, CAST(turn AS BIGINT) AS turn,
          CAST(off + length(pre) AS BIGINT) AS span_start, CAST(off + length(piece) AS BIGINT) AS span_end
        FROM co WHERE role = 'assistant'""",
    "gen_params": f"""{W} SELECT item_id, coalesce(model, 'deepseek/deepseek-r1') AS model,
        coalesce(temperature, CAST(0.6 AS DOUBLE)) AS temperature, coalesce(top_p, CAST(0.95 AS DOUBLE)) AS top_p,
        CAST(1500 AS BIGINT) AS max_tokens FROM clauses""",
    "seq_audit": """SELECT doc_id AS item_id, CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars,
        CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\r\\f]+'), lambda x: x <> '')) AS BIGINT) AS n_words,
        CAST(ceil(length(coalesce(text, '')) / 4.0) AS BIGINT) AS est_tokens,
        ceil(length(coalesce(text, '')) / 4.0) > 4096 AS over_budget FROM documents""",
    "seq_audit_hist": """SELECT CAST(floor(ceil(length(coalesce(text, '')) / 4.0) / 512) AS INTEGER) AS bucket,
        count(*) AS n, count(*) FILTER (WHERE ceil(length(coalesce(text, '')) / 4.0) > 4096) AS over_budget
        FROM documents GROUP BY ALL""",
    # ---------------- I
    "batch_predict": f"""{W}, {RESPONSES}
        SELECT item_id, model,
          CASE WHEN item_id % 97 = 0 THEN 'Error during inference: RuntimeError: stub predictor failed on item ' || CAST(item_id AS VARCHAR)
               ELSE response END AS response,
          CASE WHEN item_id % 97 = 0 THEN 'RuntimeError' END AS error_type FROM responses""",
    "batch_predict_skipped": f"""{W} SELECT item_id, 'Skipped: predictor not configured.' AS response,
        'PARSING_ERROR' AS pred_label, 'NO_JSON_FOUND' AS error_code FROM clauses""",
    "pred_records": f"{W}, {PREDS} SELECT * FROM preds",
    "completion_extract": f"""{W}, {RESPONSES}
        SELECT item_id, {strip("'  ' || coalesce(response, '') || '<end_of_turn>'")} AS completion
        FROM responses WHERE model = 'candidate'""",
    "rationale_join": f"""{W}, {RESPONSES}, r1_src AS (SELECT item_id, response AS r FROM responses WHERE model = 'baseline'),
        r1_b AS (SELECT *, strpos(r, '{{') AS bs, CASE WHEN strpos(reverse(r), '}}') > 0
                   THEN length(r) - strpos(reverse(r), '}}') + 1 ELSE 0 END AS be FROM r1_src),
        r1_s AS (SELECT *, CASE WHEN bs > 0 AND be > bs THEN substring(r, bs, be - bs + 1) END AS span FROM r1_b),
        r1_v AS (SELECT *, CASE WHEN json_valid(span) THEN CAST(span AS JSON) END AS v FROM r1_s),
        r1 AS (SELECT item_id,
          CASE WHEN r IS NULL THEN NULL WHEN span IS NULL OR v IS NULL THEN r ELSE {field_text('v', 'rationale', 'N/A')} END AS teacher_rationale,
          CASE WHEN r IS NULL THEN 'Unknown Error: ''NoneType'' object has no attribute ''find'''
               WHEN span IS NULL THEN 'Parsing Error' WHEN v IS NULL THEN 'JSON Error'
               ELSE {field_text('v', 'label', 'N/A')} END AS teacher_label FROM r1_v)
        SELECT c.item_id, c.split, c.label, r1.teacher_rationale, r1.teacher_label
        FROM clauses c LEFT JOIN r1 ON c.item_id = r1.item_id""",
    # ---------------- R
    "parse_simple": f"""{W}, {RESPONSES}, r1_src AS (SELECT item_id, model, response AS r FROM responses),
        r1_b AS (SELECT *, strpos(r, '{{') AS bs, CASE WHEN strpos(reverse(r), '}}') > 0
                   THEN length(r) - strpos(reverse(r), '}}') + 1 ELSE 0 END AS be FROM r1_src),
        r1_s AS (SELECT *, CASE WHEN bs > 0 AND be > bs THEN substring(r, bs, be - bs + 1) END AS span FROM r1_b),
        r1_v AS (SELECT *, CASE WHEN json_valid(span) THEN CAST(span AS JSON) END AS v FROM r1_s)
        SELECT item_id, model,
          CASE WHEN r IS NULL THEN 'Unknown Error: ''NoneType'' object has no attribute ''find'''
               WHEN span IS NULL THEN 'Parsing Error' WHEN v IS NULL THEN 'JSON Error'
               ELSE {field_text('v', 'label', 'N/A')} END AS label,
          CASE WHEN r IS NULL THEN NULL WHEN span IS NULL OR v IS NULL THEN r ELSE {field_text('v', 'rationale', 'N/A')} END AS rationale
        FROM r1_v""",
    "parse_strict": f"""{W}, {RESPONSES}, rs_src AS (SELECT item_id, model, response AS r FROM responses),
        {parse_ctes('rs_src', 'rs', 'pipeline')}
        SELECT item_id, model, CASE WHEN json_type(v, '$.label') = 'VARCHAR'
          THEN {strip("json_extract_string(v, '$.label')")} END AS label FROM rs_v""",
    "parse_diag": f"""{W}, {DIAG} SELECT item_id, model, pred_label, ok, error_code, error_detail, raw_snippet,
        json_substring, parsed_label, normalized_label FROM diag""",
})

# ---------------- E / C / D on lineitem-derived pairs
WP = f"WITH {LP}, {metric_ctes('pc')}"
WD = f"{W}, {PREDS}, pcd AS (SELECT model, true_label, pred_label, count(*) AS n FROM preds GROUP BY ALL), {metric_ctes('pcd')}"
WG = f"{W}, {DIAG}"


def class_report_sql() -> str:
    return f"""{WP},
    cover AS (SELECT model, sum(n) AS valid, sum(CASE WHEN list_contains({SCHEMA}, true_label) AND list_contains({SCHEMA}, pred_label) THEN 0 ELSE n END) AS outside
              FROM v GROUP BY model),
    tot AS (SELECT model, sum(tp) AS tp, sum(predicted) AS pr, sum(support) AS su, avg(precision) AS mp,
              avg(recall) AS mr, avg(f1) AS mf, sum(precision * support) AS wp, sum(recall * support) AS wr,
              sum(f1 * support) AS wf FROM pcl GROUP BY model),
    t AS (SELECT tot.*, cover.outside FROM tot JOIN cover USING (model)),
    rows AS (
      SELECT p.model, p.label AS row_name, p.label_ord AS row_ord, p.precision, p.recall, p.f1 AS f1_score, p.support
        FROM pcl p JOIN cover USING (model)
      UNION ALL SELECT model, CASE WHEN outside = 0 THEN 'accuracy' ELSE 'micro avg' END, 38,
          CASE WHEN outside = 0 THEN NULL ELSE (CASE WHEN pr > 0 THEN tp / pr ELSE 0.0 END) END,
          CASE WHEN outside = 0 THEN NULL ELSE (CASE WHEN su > 0 THEN tp / su ELSE 0.0 END) END,
          CASE WHEN su + pr > 0 THEN 2 * tp / (su + pr) ELSE 0.0 END, su FROM t
      UNION ALL SELECT model, 'macro avg', 39, mp, mr, mf, su FROM t
      UNION ALL SELECT model, 'weighted avg', 40, CASE WHEN su > 0 THEN wp / su ELSE 0.0 END,
          CASE WHEN su > 0 THEN wr / su ELSE 0.0 END, CASE WHEN su > 0 THEN wf / su ELSE 0.0 END, su FROM t)
    SELECT model, row_name, CAST(row_ord AS INTEGER) AS row_ord, round(precision, 6) AS precision,
      round(recall, 6) AS recall, round(f1_score, 6) AS f1_score, CAST(support AS BIGINT) AS support FROM rows"""


CLASSES = f"""seen AS (SELECT true_label AS label FROM pc UNION SELECT pred_label FROM pc),
    used AS (SELECT label, label_ord FROM sch WHERE label IN (SELECT label FROM seen WHERE label IS NOT NULL)
             UNION ALL SELECT 'PARSING_ERROR', 1000000 WHERE EXISTS (SELECT 1 FROM pc WHERE pred_label = 'PARSING_ERROR')),
    classes AS (SELECT CAST(row_number() OVER (ORDER BY label_ord) - 1 AS INTEGER) AS class_ord, label FROM used)"""

ORACLE_SQL.update({
    "metrics_summary": f"{WP} SELECT * FROM summ",
    "metrics_per_class": f"""{WP} SELECT model, label_ord, label, tp, predicted, support, round(precision, 6) AS precision,
        round(recall, 6) AS recall, round(f1, 6) AS f1 FROM pcl""",
    "class_report": class_report_sql(),
    "confusion_fixed": f"""{WP},
        cells AS (SELECT v.model, st.label_ord AS true_ord, sp.label_ord AS pred_ord, sum(v.n) AS n
                  FROM v JOIN sch st ON v.true_label = st.label JOIN sch sp ON v.pred_label = sp.label GROUP BY ALL)
        SELECT m.model, st.label_ord AS true_ord, sp.label_ord AS pred_ord, st.label AS true_label, sp.label AS pred_label,
          CAST(coalesce(c.n, 0) AS BIGINT) AS n
        FROM models m CROSS JOIN sch st CROSS JOIN sch sp
        LEFT JOIN cells c ON c.model = m.model AND c.true_ord = st.label_ord AND c.pred_ord = sp.label_ord""",
    "confusion_used": f"""WITH {LP}, {SCH}, {CLASSES},
        f AS (SELECT model, true_label, CASE WHEN pred_label IN (SELECT label FROM classes) THEN pred_label
                ELSE 'PARSING_ERROR' END AS pred_label, n FROM pc),
        cells AS (SELECT model, true_label, pred_label, sum(n) AS n FROM f
                  WHERE pred_label IN (SELECT label FROM classes) AND true_label IN (SELECT label FROM classes) GROUP BY ALL),
        grid AS (SELECT m.model, t.label AS true_label, p.label AS pred_label, t.class_ord AS true_ord, p.class_ord AS pred_ord
                 FROM {MODELS} CROSS JOIN classes t CROSS JOIN classes p),
        g2 AS (SELECT g.*, CAST(coalesce(c.n, 0) AS BIGINT) AS n FROM grid g LEFT JOIN cells c
               ON c.model = g.model AND c.true_label = g.true_label AND c.pred_label = g.pred_label)
        SELECT model, true_label, pred_label, true_ord, pred_ord, n, max(n) OVER () AS vmax FROM g2""",
    "labels_used_check": "",
    "error_breakdown": f"""WITH {LP},
        e AS (SELECT model, coalesce(true_label, 'None') || ' -> ' || coalesce(pred_label, 'None') AS error_type,
                CAST(sum(n) AS BIGINT) AS n FROM pc WHERE pred_label IS DISTINCT FROM true_label GROUP BY ALL)
        SELECT * FROM (SELECT model, error_type, n, CAST(row_number() OVER (PARTITION BY model ORDER BY n DESC, error_type) AS INTEGER) AS rank
          FROM e) WHERE rank <= 10""",
    "compare_metrics": f"""{WP},
        c AS (SELECT * FROM summ WHERE model = 'candidate'), b AS (SELECT * FROM summ WHERE model = 'baseline'),
        x AS (SELECT 'accuracy' AS metric, c.accuracy AS cv, b.accuracy AS bv FROM c, b
          UNION ALL SELECT 'non_none_accuracy', c.non_none_accuracy, b.non_none_accuracy FROM c, b
          UNION ALL SELECT 'precision', c.precision, b.precision FROM c, b
          UNION ALL SELECT 'recall', c.recall, b.recall FROM c, b
          UNION ALL SELECT 'f1_score', c.f1_score, b.f1_score FROM c, b)
        SELECT metric, round(cv, 6) AS candidate, round(bv, 6) AS baseline, round(cv - bv, 6) AS delta,
          round(CASE WHEN bv > 0 THEN (cv - bv) / bv * 100 ELSE 0.0 END, 6) AS delta_pct,
          CASE WHEN round(cv - bv, 6) > 0 THEN 'Improvement' WHEN round(cv - bv, 6) < 0 THEN 'Regression' ELSE 'No Change' END AS outcome
        FROM x""",
    "error_overlap": f"""WITH {LP},
        t AS (SELECT coalesce(true_label, 'None') || ' -> ' || coalesce(pred_label, 'None') AS et,
                max(CASE WHEN model = 'candidate' THEN 1 ELSE 0 END) AS in_c, max(CASE WHEN model = 'baseline' THEN 1 ELSE 0 END) AS in_b
              FROM pc WHERE pred_label IS DISTINCT FROM true_label GROUP BY 1)
        SELECT count(*) FILTER (WHERE in_c = 1 AND in_b = 1) AS common_error_types,
          count(*) FILTER (WHERE in_c = 1 AND in_b = 0) AS candidate_unique_error_types,
          count(*) FILTER (WHERE in_c = 0 AND in_b = 1) AS baseline_unique_error_types FROM t""",
    # ---- on document predictions / diagnostics
    "metrics_docs": f"{WD} SELECT * FROM summ",
    "error_table": f"{W}, {PREDS} SELECT * FROM preds WHERE pred_label IS DISTINCT FROM true_label",
    "run_summary": f"""{WD} SELECT model,
        CASE model WHEN 'candidate' THEN 'Gemma 3 12B' WHEN 'baseline' THEN 'DeepSeek R1 (Base Model)' ELSE '' END AS display_name,
        CASE model WHEN 'candidate' THEN './gemma3-12b-legal-classifier' WHEN 'baseline' THEN 'openrouter/deepseek/deepseek-r1-0528' ELSE '' END AS model_path,
        CASE WHEN model = 'baseline' THEN 'OpenRouter API' ELSE 'Local' END AS model_source,
        accuracy, correct_count, total_count,
        CASE WHEN accuracy >= 0.8 THEN 'Excellent' WHEN accuracy >= 0.6 THEN 'Good' ELSE 'Needs Improvement' END AS status
        FROM summ""",
    "diag_summary": f"""{WG}, g AS (SELECT model, CASE WHEN ok THEN NULL ELSE coalesce(error_code, 'UNKNOWN') END AS error_code,
          count(*) AS n FROM diag GROUP BY ALL),
        g2 AS (SELECT *, sum(n) OVER (PARTITION BY model) AS size,
          sum(CASE WHEN error_code IS NOT NULL THEN n ELSE 0 END) OVER (PARTITION BY model) AS total_errors FROM g)
        SELECT model, error_code, CAST(n AS BIGINT) AS n, CAST(total_errors AS BIGINT) AS total_errors, CAST(size AS BIGINT) AS size
        FROM g2 WHERE error_code IS NOT NULL""",
    "both_failed": f"{WG} SELECT item_id FROM diag WHERE NOT ok GROUP BY item_id HAVING count(DISTINCT model) = 2",
    "first_failures": f"""{WG} SELECT model, item_id, rank, error_code, pred_label, raw_snippet FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY model ORDER BY item_id) AS INTEGER) AS rank FROM diag WHERE NOT ok)
        WHERE rank <= 3""",
    "aligned": f"""{WG}, t AS (SELECT item_id, true_label AS gold, pred_label AS teacher_label, ok AS teacher_ok FROM diag WHERE model = 'baseline'),
        s AS (SELECT item_id, pred_label AS student_label, ok AS student_ok FROM diag WHERE model = 'candidate')
        SELECT coalesce(t.item_id, s.item_id) AS item_id, gold, teacher_label, teacher_ok, student_label, student_ok
        FROM t FULL OUTER JOIN s ON t.item_id = s.item_id""",
    # ---- distributions / manifest / io
    "dist_none": f"""{W}, x AS (SELECT count(*) FILTER (WHERE label IS NOT DISTINCT FROM 'NONE') AS none_count, count(*) AS total FROM clauses)
        SELECT CAST(none_count AS BIGINT) AS none_count, CAST(total - none_count AS BIGINT) AS other_count, CAST(total AS BIGINT) AS total,
          CASE WHEN total > 0 THEN round(none_count / total * 100, 6) END AS none_pct,
          CASE WHEN total > 0 THEN round((total - none_count) / total * 100, 6) END AS other_pct FROM x""",
    "dist_labels": f"{W} SELECT label, count(*) AS n FROM clauses WHERE label IS DISTINCT FROM 'NONE' GROUP BY label",
    "dist_splits": f"""{W}, g AS (SELECT split, count(*) AS n, count(*) FILTER (WHERE NOT ({LOOSE})) AS none_filtered FROM clauses GROUP BY split)
        SELECT split, CAST(n AS BIGINT) AS n, CAST(none_filtered AS BIGINT) AS none_filtered,
          CASE WHEN sum(n) OVER () > 0 THEN round(n / sum(n) OVER () * 100, 6) ELSE 0.0 END AS pct FROM g""",
    "step_estimate": f"""{W} SELECT split, count(*) AS n, CAST(floor(count(*) / 8) * 2 AS BIGINT) AS steps
        FROM clauses WHERE {LOOSE} GROUP BY split""",
    "split_manifest": f"""{W}, x AS (SELECT split, strlen(CAST(to_json(struct_pack(item_id := item_id, split := split, clause := clause,
          clause_with_context := clause_with_context, contract_type := contract_type, label := label, rationale := rationale)) AS VARCHAR)) + 1 AS b
          FROM clauses),
        g AS (SELECT split, count(*) AS rows, CAST(sum(b) AS BIGINT) AS bytes FROM x GROUP BY split)
        SELECT split, rows, bytes, CASE WHEN bytes < 1024 THEN printf('%.2f', bytes / 1.0) || ' bytes'
          WHEN bytes / 1024.0 < 1024 THEN printf('%.2f', bytes / 1024.0) || ' KB'
          WHEN bytes / 1048576.0 < 1024 THEN printf('%.2f', bytes / 1048576.0) || ' MB'
          WHEN bytes / 1073741824.0 < 1024 THEN printf('%.2f', bytes / 1073741824.0) || ' GB'
          ELSE printf('%.2f', bytes / 1099511627776.0) || ' TB' END AS size_text FROM g""",
    "jsonl_roundtrip": f"{W} SELECT item_id, split, clause, contract_type, label, rationale FROM clauses",
    "jsonl_ingest": f"{W} SELECT item_id, split, clause, contract_type, label, rationale FROM clauses",
})
ORACLE_SQL.pop("labels_used_check")


def _compare_summary() -> str:
    cols = ["accuracy", "non_none_accuracy", "precision", "recall", "f1_score"]
    sel = []
    for m in cols:
        sel += [f"round(c.{m}, 6) AS candidate_{m}", f"round(b.{m}, 6) AS baseline_{m}",
                f"round(c.{m} - b.{m}, 6) AS {m}_improvement"]

    def pct(d, base):
        return f"(CASE WHEN {base} > 0 THEN ({d}) / {base} * 100 ELSE 0.0 END)"
    cc = "(CASE WHEN c.total_count > 0 THEN c.correct_count / c.total_count ELSE 0.0 END)"
    bct = "(c.total_count - b.parsing_errors_count)"
    bc = f"(CASE WHEN {bct} > 0 THEN b.correct_count / {bct} ELSE 0.0 END)"
    csym = "(CASE WHEN c.total_count - c.parsing_errors_count > 0 THEN c.correct_count / (c.total_count - c.parsing_errors_count) ELSE 0.0 END)"
    bsym = "(CASE WHEN b.total_count - b.parsing_errors_count > 0 THEN b.correct_count / (b.total_count - b.parsing_errors_count) ELSE 0.0 END)"
    sel += [
        f"round({pct('c.accuracy - b.accuracy', 'b.accuracy')}, 6) AS overall_improvement_pct",
        f"round({pct('c.non_none_accuracy - b.non_none_accuracy', 'b.non_none_accuracy')}, 6) AS non_none_improvement_pct",
        f"round({cc}, 6) AS candidate_clean_accuracy", f"round({bc}, 6) AS baseline_clean_accuracy",
        "c.correct_count AS candidate_clean_correct", "b.correct_count AS baseline_clean_correct",
        "c.total_count AS candidate_clean_total", f"{bct} AS baseline_clean_total",
        f"round({cc} - {bc}, 6) AS clean_improvement", f"round({pct(f'{cc} - {bc}', bc)}, 6) AS clean_improvement_pct",
        f"round({csym}, 6) AS candidate_clean_accuracy_sym", f"round({bsym}, 6) AS baseline_clean_accuracy_sym",
        "c.correct_count AS candidate_correct", "b.correct_count AS baseline_correct", "c.total_count AS total_samples",
        "c.parsing_errors_count AS candidate_parsing_errors", "b.parsing_errors_count AS baseline_parsing_errors",
        "b.parsing_errors_count - c.parsing_errors_count AS parsing_error_reduction",
        "c.total_count - c.correct_count AS candidate_total_errors",
        "b.total_count - b.correct_count AS baseline_total_errors",
    ]
    return (f"""{WD}, c AS (SELECT * FROM summ WHERE model = 'candidate'), b AS (SELECT * FROM summ WHERE model = 'baseline')
        SELECT 'candidate' AS candidate, 'baseline' AS baseline, """ + ",\n  ".join(sel) + " FROM c, b")


ORACLE_SQL["compare_summary"] = _compare_summary()

DERIVED = f"""derived AS (SELECT DISTINCT {strip0('label')} AS label FROM clauses
  WHERE split = 'test' AND {strip0('label')} <> '' AND upper({strip0('label')}) <> 'NONE')"""

_TEACHER = """r1_src AS (SELECT item_id,
          CASE WHEN item_id % 97 = 0 THEN 'Error during inference: RuntimeError: stub predictor failed on item '
               || CAST(item_id AS VARCHAR) ELSE response END AS r,
          CASE WHEN item_id % 97 <> 0 AND response IS NOT NULL THEN 'reasoning ' || CAST(item_id AS VARCHAR) END AS reasoning_trace
        FROM responses WHERE model = 'baseline')"""

ORACLE_SQL.update({
    "parse_diag_derived": f"""{W}, {DERIVED}, {DIAG},
        x AS (SELECT item_id, model, raw, norm,
              CASE WHEN st < 4 THEN st WHEN norm IN (SELECT label FROM derived) THEN 5 ELSE 4 END AS st FROM rd_n)
        SELECT item_id, model, CASE WHEN st = 5 THEN norm ELSE 'PARSING_ERROR' END AS pred_label, st = 5 AS ok,
          CASE st WHEN 0 THEN 'NO_RESPONSE' WHEN 1 THEN 'NO_JSON_FOUND' WHEN 2 THEN 'JSON_DECODE_ERROR'
            WHEN 3 THEN 'MISSING_LABEL_FIELD' WHEN 4 THEN 'INVALID_LABEL' END AS error_code,
          CASE st WHEN 0 THEN 'Model returned empty response.' WHEN 1 THEN 'Could not find brace-delimited JSON in response.'
            WHEN 2 THEN 'JSONDecodeError: invalid JSON' WHEN 3 THEN 'Parsed JSON but no usable ''label'' found.'
            WHEN 4 THEN 'Label ''' || norm || ''' not in valid label set.' END AS error_detail,
          CASE WHEN st >= 4 THEN raw END AS parsed_label, CASE WHEN st >= 4 THEN norm END AS normalized_label FROM x""",
    "run_metadata": f"""{WD} SELECT model,
        CASE model WHEN 'candidate' THEN './gemma3-12b-legal-classifier'
          WHEN 'baseline' THEN 'openrouter/deepseek/deepseek-r1-0528' ELSE '' END AS model_path, accuracy,
        (SELECT count(*) FILTER (WHERE label IS NOT DISTINCT FROM 'NONE') FROM clauses WHERE split = 'test') AS excluded_none,
        'documents' AS test_data_path, CASE model WHEN 'candidate' THEN 'google/gemma-3-12b-it' ELSE '' END AS base_model,
        CAST(NULL AS VARCHAR) AS timestamp FROM summ""",
    "text_only": f"SELECT text FROM ({ORACLE_SQL['sft_text']})",
    "text_repair": ORACLE_SQL["sft_text"],
    "api_messages": f"{W} SELECT item_id, 0 AS msg_index, 'user' AS role, {PROMPT_TRAIN} AS content FROM clauses",
    "split_single": ORACLE_SQL["split_hash"],
    "jsonl_guard": f"""{W} SELECT item_id, CASE WHEN item_id % 68 < 67 THEN 's' || CAST(item_id % 68 AS VARCHAR) END AS split,
        true AS wrote_first, false AS wrote_again FROM clauses""",
    "teacher_collect": ORACLE_SQL["rationale_join"].replace(
        "r1_src AS (SELECT item_id, response AS r FROM responses WHERE model = 'baseline')", _TEACHER).replace(
        "r1 AS (SELECT item_id,", "r1 AS (SELECT item_id, reasoning_trace,").replace(
        "c.label, r1.teacher_rationale", "c.label, r1.reasoning_trace, r1.teacher_rationale"),
})

ODD_SPLITS = ["full", "a/b", "a:b", "", "train", "Ü ñ%~+*=_", "n", "s" * 200]
ORACLE_SQL.update({
    "jsonl_publish": f"""{W}, x AS (SELECT item_id, [{', '.join(map(q, ODD_SPLITS))}, NULL][item_id % {len(ODD_SPLITS) + 1} + 1] AS split,
          label FROM clauses) SELECT *, split AS read_from FROM x""",
    "shuffle_order": f"""{W} SELECT item_id, row_number() OVER (ORDER BY md5('42:' || CAST(item_id AS VARCHAR)), item_id) - 1 AS position
        FROM clauses""",
})


def _templates() -> str:
    """Two renderings of whole conversations by the model's template."""
    both = f"""WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS x, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn,
          first_value(role) OVER (PARTITION BY conv_id ORDER BY turn) = 'system' AS sys,
          first_value(text) OVER (PARTITION BY conv_id ORDER BY turn) AS lead FROM conversations),
        p AS (SELECT conv_id, turn,
            CASE WHEN sys AND rn = 1 THEN '' ELSE
              (CASE role WHEN 'user' THEN {USER_P} WHEN 'assistant' THEN {MODEL_P} WHEN 'model' THEN {MODEL_P}
                 ELSE '<start_of_turn>' || role || {NL} END)
              || (CASE WHEN sys AND rn = 2 THEN {strip0('lead')} || {NL} || {NL} ELSE '' END) || {strip('x')} || {EOT} END AS g,
            '<|im_start|>' || role || {NL} || x || '<|im_end|>' || {NL} AS c FROM t),
        r AS (SELECT conv_id, '<bos>' || string_agg(g, '' ORDER BY turn) AS g, string_agg(c, '' ORDER BY turn) AS c FROM p GROUP BY conv_id)"""
    return f"""{both} SELECT conv_id, ['gemma', 'chatml', 'unknown'][conv_id % 3 + 1] AS model,
          CASE conv_id % 3 WHEN 0 THEN g WHEN 1 THEN c END AS text,
          CASE conv_id % 3 WHEN 0 THEN g || {MODEL_P} WHEN 1 THEN c || '<|im_start|>assistant' || {NL} END AS prompt FROM r"""


def _sets(failed: str, key: str, models: list[str], n: str) -> str:
    """``failed``: a query of (key, model); the sets of models that share a key."""
    return f"""SELECT models, CAST(len(string_split(models, ',')) AS INTEGER) AS n_models, count(*) AS {n} FROM (
        SELECT {key}, string_agg(DISTINCT model, ',' ORDER BY list_position([{', '.join(map(q, models))}], model)) AS models
        FROM ({failed}) GROUP BY {key}) GROUP BY models"""


SIX = [f"model{k}" for k in range(6)]
SIX_DIAG = WG.replace(MODELS, "(VALUES " + ", ".join(f"({k}, {q(m)})" for k, m in enumerate(SIX)) + ") m(k, model)")
ORDER_KEYS = "substr(o_orderpriority, 1, 1) <= '3'"
ORACLE_SQL.update({
    "sample_counts": f"""{W}, t AS (SELECT * FROM clauses WHERE split = 'test'),
        a AS (SELECT count(*) AS total, count(*) FILTER (label = 'NONE') AS excluded FROM t),
        s AS (SELECT item_id, md5('42:' || CAST(item_id AS VARCHAR)) AS shuffle_key FROM t WHERE label IS DISTINCT FROM 'NONE'
              ORDER BY shuffle_key, item_id LIMIT 50)
        SELECT s.*, CAST(50 AS BIGINT) AS requested, total, excluded, total - excluded AS available,
          least(50, total - excluded) AS sampled FROM s, a""",
    "labels_dim": f"""{W}, {SCH}, n AS (SELECT {strip0('label')} AS label, count(*) AS n FROM clauses GROUP BY 1)
        SELECT label_ord, label, coalesce(n, 0) AS n, label <> 'NONE' AS in_prompt, true AS in_prompt_with_none
        FROM sch LEFT JOIN n USING (label)""",
    "chat_templates": _templates(),
    "predict_resume": f"""{W}, {PREDS}, a AS (SELECT * FROM preds WHERE model = 'candidate')
        SELECT item_id, model, true_label, CASE WHEN item_id % 97 = 0 THEN 'PARSING_ERROR' ELSE pred_label END AS pred_label,
          CASE WHEN item_id % 97 = 0 THEN 'Error during inference: RuntimeError: stub predictor failed on item ' || item_id
               ELSE response END AS response,
          CASE WHEN CAST('0x' || substr(md5(CAST(item_id AS VARCHAR)), 1, 8) AS BIGINT) % 4 < 2 THEN CAST(1 AS BIGINT) ELSE 2 END AS run FROM a""",
    "parse_diag_many_labels": f"""SELECT o_orderkey AS item_id, CASE WHEN {ORDER_KEYS} THEN 'order ' || o_orderkey ELSE 'PARSING_ERROR' END AS pred_label,
          {ORDER_KEYS} AS ok, CASE WHEN NOT {ORDER_KEYS} THEN 'INVALID_LABEL' END AS error_code,
          CASE WHEN NOT {ORDER_KEYS} THEN 'Label ' || chr(39) || 'order ' || o_orderkey || chr(39) || ' not in valid label set.' END AS error_detail FROM orders""",
    "error_breakdown_first": f"""{W}, {PREDS},
        e AS (SELECT model, coalesce(true_label, 'None') || ' -> ' || coalesce(pred_label, 'None') AS error_type, count(*) AS n,
                min(item_id) AS "first" FROM preds WHERE pred_label IS DISTINCT FROM true_label GROUP BY ALL)
        SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY model ORDER BY n DESC, "first") AS INTEGER) AS rank FROM e)
        WHERE rank <= 10""",
    "confusion_wide": f"""WITH {LP}, {SCH}, c AS (
          SELECT model, t.label_ord AS true_ord, p.label_ord AS pred_ord, n FROM pc JOIN sch t ON t.label = true_label JOIN sch p ON p.label = pred_label),
        g AS (SELECT model, label_ord AS true_ord, label AS true_label FROM (SELECT DISTINCT model FROM pc), sch)
        SELECT model, true_ord, true_label, {', '.join(f"CAST(coalesce(sum(n) FILTER (pred_ord = {i}), 0) AS BIGINT) AS p{i}" for i in range(len(LABEL_SCHEMA)))},
          CAST(coalesce(sum(n), 0) AS BIGINT) AS row_total FROM g LEFT JOIN c USING (model, true_ord) GROUP BY ALL""",
    "failing_sets": f"{WG}, f AS (SELECT item_id, model FROM diag WHERE NOT ok) {_sets('FROM f', 'item_id', ['candidate', 'baseline'], 'n_items')}",
    "failing_sets_six": f"{SIX_DIAG}, f AS (SELECT item_id, model FROM diag WHERE NOT ok) {_sets('FROM f', 'item_id', SIX, 'n_items')}",
    "error_type_sets": f"""WITH {LP}, f AS (SELECT DISTINCT model, coalesce(true_label, 'None') || ' -> ' || coalesce(pred_label, 'None') AS et
          FROM pc WHERE pred_label IS DISTINCT FROM true_label) {_sets('FROM f', 'et', ['candidate', 'baseline'], 'n_error_types')}""",
})
