"""Prompt, chat and SFT-record construction.

JSON texts are built as a constant skeleton plus escaped values, so the bytes
match a ``json.dumps(..., ensure_ascii=False)`` writer (``", "`` and ``": "``
separators, raw UTF-8) while staying inside Catalyst expressions.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import (CLASSIFY_INSTRUCTIONS, CLASSIFY_TASK, FEW_SHOT, GEN_DEFAULTS,
                                   MAX_SEQ_LENGTH, MODEL_TURN_MARKER, NONE_LABEL,
                                   RATIONALE_PROMPT_TEMPLATE, SCHEMA_LABEL_DESC,
                                   SCHEMA_RATIONALE_DESC, TEACHER_SYSTEM, USER_TURN_MARKER)
from ..functions.text import col_, json_escape, py_strip, strip_or_empty
from .labels import valid_labels as _valid_labels


def _dumps(x) -> str:
    return json.dumps(x, ensure_ascii=False)


# ---------------------------------------------------------------- T1 / T4
def classify_prompt(clause="clause", clause_with_context="clause_with_context",
                    contract_type="contract_type", labels: list[str] | None = None,
                    unknown_default: str = "") -> Column:
    """Classification prompt JSON (task, instructions, schema, valid_labels, inputs)."""
    labels = _valid_labels(False) if labels is None else labels
    head = ('{"task": ' + _dumps(CLASSIFY_TASK) + ', "instructions": ' + _dumps(CLASSIFY_INSTRUCTIONS)
            + ', "schema": {"rationale": ' + _dumps(SCHEMA_RATIONALE_DESC) + ', "label": '
            + _dumps(SCHEMA_LABEL_DESC) + '}, "valid_labels": ' + _dumps(list(labels))
            + ', "inputs": {"clause": ')
    ct = strip_or_empty(contract_type)
    ct = F.when(ct == "", F.lit(unknown_default)).otherwise(ct)
    return F.concat(F.lit(head), json_escape(strip_or_empty(clause)),
                    F.lit(', "clause_with_context": '), json_escape(strip_or_empty(clause_with_context)),
                    F.lit(', "contract_type": '), json_escape(ct), F.lit("}}"))


def target_label(label="label") -> Column:
    """Assistant label: null/empty -> NONE, else stripped (so '  ' -> '')."""
    c = col_(label)
    return F.when(c.isNull() | (c == ""), F.lit(NONE_LABEL)).otherwise(py_strip(c))


def sft_target(rationale="rationale", label="label") -> Column:
    """T4: ``{"rationale": ..., "label": ...}``, rationale first."""
    return F.concat(F.lit('{"rationale": '), json_escape(strip_or_empty(rationale)),
                    F.lit(', "label": '), json_escape(target_label(label)), F.lit("}"))


# ---------------------------------------------------------------- T2
def render_template(template: str, **cols) -> Column:
    """Fill ``{name}`` placeholders with columns (null renders as '')."""
    parts = re.split(r"\{(\w+)\}", template)
    out = []
    for i, p in enumerate(parts):
        if i % 2 == 0:
            if p:
                out.append(F.lit(p))
        else:
            out.append(F.coalesce(col_(cols.get(p, p)).cast("string"), F.lit("")))
    return F.concat(*out)


def rationale_prompt(clause="clause", clause_with_context="clause_with_context",
                     contract_type="contract_type", label="label") -> Column:
    """Rationale-generation prompt; values are not stripped."""
    return render_template(RATIONALE_PROMPT_TEMPLATE, clause=clause,
                           clause_with_context=clause_with_context,
                           contract_type=contract_type, label=label)


# ---------------------------------------------------------------- T3 / T5
MSG = "array<struct<role:string,content:string>>"


def teacher_messages(prompt: Column) -> Column:
    """System + two few-shot pairs + the item prompt, API message form."""
    items = [F.struct(F.lit("system").alias("role"), F.lit(TEACHER_SYSTEM).alias("content"))]
    items += [F.struct(F.lit(r).alias("role"), F.lit(c).alias("content")) for r, c in FEW_SHOT]
    items.append(F.struct(F.lit("user").alias("role"), prompt.alias("content")))
    return F.array(*items)


def _content(text: Column) -> Column:
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text")))


def conversation(prompt: Column, target: Column | None = None) -> Column:
    """T5: ``[{role, content: [{type, text}]}]`` -- train form with a target,
    local inference form (user only) without."""
    turns = [F.struct(F.lit("user").alias("role"), _content(prompt).alias("content"))]
    if target is not None:
        turns.append(F.struct(F.lit("assistant").alias("role"), _content(target).alias("content")))
    return F.array(*turns)


def api_messages(prompt: Column) -> Column:
    """T5 API form: ``[{role: user, content: str}]``."""
    return F.array(F.struct(F.lit("user").alias("role"), prompt.alias("content")))


# ---------------------------------------------------------------- T6 / T7 / T8
@dataclass(frozen=True)
class ChatTemplate:
    """A chat template as data: BOS, per-role turn prefix, turn suffix."""
    bos: str = "<bos>"
    role_prefix: dict = field(default_factory=lambda: {
        "user": USER_TURN_MARKER, "assistant": MODEL_TURN_MARKER, "model": MODEL_TURN_MARKER})
    turn_suffix: str = "<end_of_turn>\n"
    generation_prefix: str = MODEL_TURN_MARKER
    system_joiner: str = "\n\n"   # a leading system turn is folded into the next turn
    trim_content: bool = True
    fold_system: bool = True

    def prefix(self, role: Column) -> Column:
        e = None
        for r, p in self.role_prefix.items():
            e = F.when(role == r, F.lit(p)) if e is None else e.when(role == r, F.lit(p))
        return e.otherwise(F.concat(F.lit("<start_of_turn>"), role, F.lit("\n")))

    def body(self, text: Column) -> Column:
        t = F.coalesce(text, F.lit(""))
        return py_strip(t) if self.trim_content else t


GEMMA3 = ChatTemplate()


TEMPLATE_SCHEMA = ("model string, bos string, role_prefix map<string,string>, other_open string, other_close string, "
                   "turn_suffix string, generation_prefix string, system_joiner string, fold_system boolean, trim_content boolean")


class TemplateColumns:
    """A chat template whose parts are columns of each row (``TEMPLATE_SCHEMA``).  Roles
    without a prefix of their own are written between ``other_open`` and ``other_close``;
    without ``fold_system`` a system turn is a turn like others."""

    def __init__(self, at: str = "_tpl"):
        def part(name):
            return F.col(f"{at}.{name}")
        self.bos, self.turn_suffix, self.generation_prefix = part("bos"), part("turn_suffix"), part("generation_prefix")
        self.system_joiner, self.fold_system = part("system_joiner"), part("fold_system")
        self._roles, self._trim = part("role_prefix"), part("trim_content")
        self._open, self._close = part("other_open"), part("other_close")

    def prefix(self, role: Column) -> Column:
        return F.coalesce(F.try_element_at(self._roles, role), F.concat(self._open, role, self._close))

    def body(self, text: Column) -> Column:
        t = F.coalesce(text, F.lit(""))
        return F.when(self._trim, py_strip(t)).otherwise(t)


def _turn_text(content: Column) -> Column:
    """Text of a ``content`` array: its text items concatenated."""
    texts = F.transform(F.filter(content, lambda c: c["type"] == "text"), lambda c: c["text"])
    return F.array_join(texts, "", "")


def flat_turns(conv: Column) -> Column:
    """``array<struct<role, content: array<struct<type,text>>>>`` -> ``array<struct<role, text>>``."""
    return F.transform(conv, lambda m: F.struct(m["role"].alias("role"), _turn_text(m["content"]).alias("text")))


def _pieces(turns: Column, tpl: ChatTemplate) -> Column:
    """Rendered piece per non-system turn: ``array<struct<role, piece, prefix_len>>``."""
    first_sys = F.coalesce((turns[0]["role"] == "system") & F.lit(tpl.fold_system), F.lit(False))
    sys_text = F.when(first_sys, F.concat(tpl.body(turns[0]["text"]), F.lit(tpl.system_joiner))).otherwise(F.lit(""))
    loop = F.when(first_sys, F.slice(turns, 2, F.greatest(F.size(turns) - 1, F.lit(0)))).otherwise(turns)

    def piece(m, i):
        pre = tpl.prefix(m["role"])
        lead = F.when(i == 0, sys_text).otherwise(F.lit(""))
        return F.struct(m["role"].alias("role"),
                        F.concat(pre, lead, tpl.body(m["text"]), F.lit(tpl.turn_suffix)).alias("piece"),
                        F.length(pre).alias("prefix_len"))
    return F.transform(loop, piece)


def render_chat(turns: Column, tpl: ChatTemplate = GEMMA3, add_generation_prompt: bool = False) -> Column:
    """Render ``array<struct<role, text>>`` with the template.

    Training form: BOS + every turn.  Inference form adds the open model turn.
    """
    body = F.array_join(F.transform(_pieces(turns, tpl), lambda p: p["piece"]), "", "")
    out = F.concat(F.lit(tpl.bos), body)
    if add_generation_prompt:
        out = F.concat(out, F.lit(tpl.generation_prefix))
    return out


def render_by_template(df: DataFrame, templates: DataFrame, turns: Column, by: str = "model",
                       add_generation_prompt: bool = False, out: str = "text") -> DataFrame:
    """T6 / T7 with one template per row: ``df`` joined on ``by`` to a template table
    (``TEMPLATE_SCHEMA``, one row per value of ``by``); null where it has none."""
    row = templates.select(F.col(by), F.struct(*[c for c in templates.columns if c != by]).alias("_tpl"))
    joined = df.join(row, by, "left")
    return joined.withColumn(out, render_chat(turns, TemplateColumns(), add_generation_prompt)).drop("_tpl")


def template_row(model: str, tpl: ChatTemplate) -> tuple:
    """A row of a template table from a template."""
    return (model, tpl.bos, dict(tpl.role_prefix), "<start_of_turn>", "\n", tpl.turn_suffix, tpl.generation_prefix,
            tpl.system_joiner, tpl.fold_system, tpl.trim_content)


def roles_alternate(turns: Column) -> Column:
    """True when non-system turns alternate user / assistant starting with user."""
    first_sys = F.coalesce(turns[0]["role"] == "system", F.lit(False))
    loop = F.when(first_sys, F.slice(turns, 2, F.greatest(F.size(turns) - 1, F.lit(0)))).otherwise(turns)
    bad = F.filter(F.transform(loop, lambda m, i: (m["role"] == "user") != (i % 2 == 0)), lambda b: b)
    return F.size(bad) == 0


def loss_spans(turns: Column, tpl: ChatTemplate = GEMMA3, train_role: str = "assistant") -> Column:
    """0-based half-open char spans of trained text in the rendered chat.

    Each span starts after a response marker and runs to the start of the next
    turn (or the end): the assistant text plus its end-of-turn marker.  One pass
    over the turns carries the offset; for long conversations use
    ``loss_span_rows``.
    """
    span = "struct<start:bigint,end:bigint>"
    zero = F.struct(F.lit(len(tpl.bos)).cast("long").alias("at"), F.array().cast(f"array<{span}>").alias("spans"))

    def step(acc, p):
        end = acc["at"] + F.length(p["piece"])
        own = F.struct((acc["at"] + p["prefix_len"]).cast("long").alias("start"), end.cast("long").alias("end"))
        trained = F.when(p["role"] == train_role, F.concat(acc["spans"], F.array(own))).otherwise(acc["spans"])
        return F.struct(end.cast("long").alias("at"), trained.cast(f"array<{span}>").alias("spans"))
    return F.aggregate(_pieces(turns, tpl), zero, step, lambda acc: acc["spans"])


def turn_offsets(df: DataFrame, key: str = "conv_id", order: str = "turn", tpl: ChatTemplate = GEMMA3) -> DataFrame:
    """Long-form rendering: one row per rendered turn with its 0-based character
    offset, the length of its prefix, and its end in the conversation's text.

    A leading system turn is folded into the next turn.  No row needs another
    row's text for that: the running sum goes over every turn as if it stood for
    itself, and a conversation's first turn, known from the running sum, says how
    much longer or shorter the folded form is.  There is no join or window on the
    conversation alone, so one that holds most of the rows spreads over many tasks.
    """
    from .ranking import segmented_offsets
    pre = tpl.prefix(F.col("role"))
    body = tpl.body(F.col("text"))
    t = df.select(key, order, "role", F.length(pre).cast("long").alias("prefix_len"),
                  F.length(F.concat(pre, body, F.lit(tpl.turn_suffix))).cast("long").alias("_len"),
                  F.length(F.concat(body, F.lit(tpl.system_joiner))).cast("long").alias("_lead"))
    r = segmented_offsets(t, key, order, "_len", ["role", "_len", "_lead"])
    folded = F.coalesce(F.col("_first.role") == "system", F.lit(False))
    first = F.col(order) == F.col("_first._order")
    own = F.col("_before") - F.when(folded, F.col("_first._len")).otherwise(0)
    lead = F.when(folded, F.col("_first._lead")).otherwise(0)
    bos = F.lit(len(tpl.bos))
    return r.filter(~(folded & first)).select(
        key, order, "role", "prefix_len",
        (bos + F.when(own == 0, 0).otherwise(own + lead)).alias("offset"),
        (bos + own + lead + F.col("_len")).alias("end"))


def loss_span_rows(df: DataFrame, key: str = "conv_id", order: str = "turn", tpl: ChatTemplate = GEMMA3,
                   train_role: str = "assistant") -> DataFrame:
    """T8 in long form: (key, turn, span_start, span_end) per trained turn."""
    p = turn_offsets(df, key, order, tpl).filter(F.col("role") == train_role)
    return p.select(key, order, (F.col("offset") + F.col("prefix_len")).alias("span_start"), F.col("end").alias("span_end"))


def turns_from_rows(df: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """Long-form turns (key, turn, role, text) -> (key, turns array) ordered by turn.

    One conversation is one output record, so its turns are gathered into one
    value; partial aggregation is not possible for an ordered concatenation.
    """
    agg = df.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(order, "role", "text"))).alias("_t"))
    return agg.select(key, F.transform("_t", lambda m: F.struct(m["role"].alias("role"),
                                                                m["text"].alias("text"))).alias("turns"))


# ---------------------------------------------------------------- T9 / T10 / T11
CHARS_PER_TOKEN = 4.0


def seq_audit(text="text", model_size: str = "12b", chars_per_token: float = CHARS_PER_TOKEN) -> list[Column]:
    """Length report against the model's sequence budget (estimate, not a tokenizer)."""
    t = F.coalesce(col_(text), F.lit(""))
    n_chars = F.length(t).cast("long")
    n_words = F.size(F.filter(F.split(t, "[ \\t\\n\\r\\f]+"), lambda x: x != "")).cast("long")
    est = F.ceil(n_chars / F.lit(chars_per_token)).cast("long")
    budget = MAX_SEQ_LENGTH[model_size]
    return [n_chars.alias("n_chars"), n_words.alias("n_words"), est.alias("est_tokens"),
            (est > F.lit(budget)).alias("over_budget")]


def gen_params(overrides: dict | None = None, defaults: dict = GEN_DEFAULTS,
               columns=("model", "temperature", "top_p")) -> list[Column]:
    """Per-row generation settings with defaults; call-wide overrides win."""
    overrides = overrides or {}
    out = []
    for k in ["model", "temperature", "top_p", "max_tokens"]:
        typ = "string" if k == "model" else ("long" if k == "max_tokens" else "double")
        if k in overrides:
            v = F.lit(overrides[k]).cast(typ)
        elif k in columns:
            v = F.coalesce(F.col(k).cast(typ), F.lit(defaults[k]).cast(typ))
        else:
            v = F.lit(defaults[k]).cast(typ)
        out.append(v.alias(k))
    return out


def ensure_text(df: DataFrame, conv_col: str = "conversations", tpl: ChatTemplate = GEMMA3) -> DataFrame:
    """When ``text`` is not a string column (e.g. token ids), re-render it
    from the conversations for the whole table."""
    dtype = dict(df.dtypes).get("text")
    if dtype == "string":
        return df
    return df.withColumn("text", render_chat(flat_turns(F.col(conv_col)), tpl))
