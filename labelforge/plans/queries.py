"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver tables (``documents``, ``labels``,
``conversations``, ``lineitem``) through the fixture adapters and runs the
operators over whole tables and whole texts.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable

from pyspark.errors import PythonException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import LABEL_SCHEMA
from ..functions.text import truncate_text
from ..operators import compare as C
from ..operators import labels as L
from ..operators import ledger as G
from ..operators import metrics as E
from ..operators import parsing as Rp
from ..operators import predict as I
from ..operators import prompts as T
from ..operators import records as Fr
from ..operators import sampling as P
from ..session import apply_required_conf, checkpoint_dir, materialize
from ..sources import fixtures as X
from ..sources import jsonl as S
from ..sources.tables import read_table

CAND, BASE = X.MODELS
SEED = 42
MODEL_META = {
    CAND: {"display_name": "Gemma 3 12B", "model_path": X.MODEL_PATHS[CAND], "use_local_model": True},
    BASE: {"display_name": "DeepSeek R1 (Base Model)", "model_path": X.MODEL_PATHS[BASE], "use_local_model": False},
}
NON_NONE = L.valid_labels(False)
ODD_SPLITS = ["full", "a/b", "a:b", "", "train", "Ü ñ%~+*=_", "n", "s" * 200]


# ------------------------------------------------------------------ shared inputs
def clauses(spark, d):
    apply_required_conf(spark)
    return X.clauses(spark, d)


def responses(spark, d):
    return X.stub_responses(clauses(spark, d))


def diag(spark, d):
    """R3 over every response, joined back to the gold label."""
    c = clauses(spark, d).select("item_id", F.coalesce(Fr.strip_or_empty("label"), F.lit("")).alias("true_label"))
    return parsed(spark, d).join(c, "item_id")


def parsed(spark, d):
    """R3 over every response, without the gold label."""
    return Rp.parse_diagnostics(responses(spark, d), labels=NON_NONE)


def preds(spark, d):
    return I.prediction_records(clauses(spark, d), responses(spark, d), X.MODELS)


def pairs(spark, d):
    """Pair counts of the lineitem-derived predictions, materialised once."""
    return materialize(E.pair_counts(X.label_pairs(spark, d)))


def doc_pairs(spark, d):
    """Pair counts of the document predictions, materialised once."""
    return materialize(E.pair_counts(preds(spark, d)))


# ------------------------------------------------------------------ F: records
def q_corpus_normalize(spark, d):
    c = clauses(spark, d).select("item_id", "split", "clause", "clause_with_context", "contract_type",
                                 "label", "rationale")
    n = Fr.normalize(c)
    return n.withColumn("contract_type_or_unknown",
                        F.when(F.col("contract_type") == "", "Unknown").otherwise(F.col("contract_type")))


def q_corpus_none_loose(spark, d):
    return Fr.drop_none_loose(clauses(spark, d)).select("item_id", "split", "label")


def q_corpus_none_exact(spark, d):
    return Fr.drop_none_exact(clauses(spark, d)).select("item_id", "split", "label")


def q_corpus_none_counts(spark, d):
    c = clauses(spark, d)
    a = Fr.none_filter_counts(c, loose=False).select(F.lit("exact").alias("mode"), "*")
    b = Fr.none_filter_counts(c, loose=True).select(F.lit("loose").alias("mode"), "*")
    return a.unionByName(b)


def q_corpus_cap(spark, d):
    c = Fr.drop_none_loose(clauses(spark, d))
    return Fr.cap_first_n(c, 100).select("item_id", "split", "label")


def q_corpus_truncate(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    return docs.select(F.col("doc_id").alias("item_id"), truncate_text("text", 500).alias("text_500"),
                       F.length("text").cast("long").alias("n_chars"))


def q_corpus_preview(spark, d):
    return Fr.drop_teacher_columns(Fr.preview(clauses(spark, d), 7)).select(
        "item_id", "split", "clause", "contract_type", "label")


# ------------------------------------------------------------------ P: sampling
def q_shuffle_key(spark, d):
    return clauses(spark, d).select("item_id", P.shuffle_key(SEED).alias("shuffle_key"))


def q_shuffle_order(spark, d):
    """The place of every clause in the seeded shuffle."""
    return P.shuffled(clauses(spark, d).select("item_id"), SEED).select("item_id", "position")


def q_sample_eval(spark, d):
    test = clauses(spark, d).filter(F.col("split") == "test")
    s = P.sample_eval(test, num_samples=50, exclude_none=True, randomize=True, seed=SEED)
    return s.select("item_id", "label", "shuffle_key")


def q_sample_eval_loose(spark, d):
    base = P.base_split(clauses(spark, d), names=["train", "validation", "test"])
    return P.sample_eval_loose(base, num_samples=5, seed=SEED).select("item_id", "label", "shuffle_key")


def q_split_hash(spark, d):
    return P.split_hash(clauses(spark, d).select("item_id"), 0.1, SEED)


def q_split_exact(spark, d):
    return P.split_exact(clauses(spark, d).select("item_id"), 0.1, SEED)


def q_split_resolve(spark, d):
    c = clauses(spark, d).select("item_id", "split")
    return P.resolve_splits(c).select("item_id", "split", "role")


def q_split_single(spark, d):
    """P5 on one dataset without splits."""
    return P.resolve_splits(clauses(spark, d).select("item_id"))


def q_sample_counts(spark, d):
    """F4 + P2: what was asked for, excluded, there and sampled, from the job that draws the sample."""
    test = clauses(spark, d).filter(F.col("split") == "test")
    sample, counts = P.sample_eval_counted(test, 50, randomize=True, seed=SEED)
    return sample.select("item_id", "shuffle_key", *[F.lit(v).cast("long").alias(k) for k, v in counts.items()])


# ------------------------------------------------------------------ L: labels
def q_labels_dim(spark, d):
    return L.label_usage(clauses(spark, d))


def q_labels_derived(spark, d):
    base = P.base_split(clauses(spark, d), names=["train", "validation", "test"])
    return L.derived_labels(base)


def q_labels_used(spark, d):
    return L.classes_in_use(pairs(spark, d), L.label_dim(spark))


def q_labels_validate(spark, d):
    c = clauses(spark, d)
    s = Fr.strip_or_empty("label")
    return c.select("item_id", s.alias("label"), L.validate_label(s).alias("valid_label"))


# ------------------------------------------------------------------ T: prompts
def q_prompt_classify(spark, d):
    c = clauses(spark, d)
    return c.select("item_id", T.classify_prompt(labels=NON_NONE).alias("prompt"))


def q_prompt_classify_nb(spark, d):
    c = clauses(spark, d)
    return c.select("item_id", T.classify_prompt(labels=LABEL_SCHEMA, unknown_default="Unknown").alias("prompt"))


def q_prompt_rationale(spark, d):
    return clauses(spark, d).select("item_id", T.rationale_prompt().alias("prompt"))


def q_teacher_messages(spark, d):
    c = clauses(spark, d)
    msgs = T.teacher_messages(T.classify_prompt(labels=NON_NONE, unknown_default="Unknown"))
    x = c.select("item_id", F.posexplode(msgs).alias("msg_index", "m"))
    return x.select("item_id", F.col("msg_index").cast("int"), "m.role", "m.content")


def q_sft_target(spark, d):
    return clauses(spark, d).select("item_id", T.sft_target().alias("target"))


def _train_conv(c: DataFrame) -> DataFrame:
    return c.select("item_id", T.conversation(T.classify_prompt(labels=NON_NONE), T.sft_target()).alias("conversations"))


def q_conversation_record(spark, d):
    conv = _train_conv(Fr.drop_none_loose(clauses(spark, d)))
    x = conv.select("item_id", F.posexplode("conversations").alias("turn", "m"))
    return x.select("item_id", F.col("turn").cast("int"), F.col("m.role").alias("role"),
                    F.col("m.content")[0]["type"].alias("content_type"), F.col("m.content")[0]["text"].alias("text"))


def q_sft_text(spark, d):
    conv = _train_conv(Fr.drop_none_loose(clauses(spark, d)))
    return conv.select("item_id", T.render_chat(T.flat_turns(F.col("conversations"))).alias("text"))


def q_text_only(spark, d):
    """the training text as the only column."""
    conv = _train_conv(Fr.drop_none_loose(clauses(spark, d)))
    return Fr.only_text(conv.select("item_id", T.render_chat(T.flat_turns(F.col("conversations"))).alias("text")))


def q_text_repair(spark, d):
    """A ``text`` column of token ids is replaced by the rendered text."""
    conv = _train_conv(Fr.drop_none_loose(clauses(spark, d))).withColumn("text", F.array(F.lit(1), F.lit(2)))
    return T.ensure_text(conv).select("item_id", "text")


def q_api_messages(spark, d):
    """T5: the (role, content) messages of an API call."""
    msgs = T.api_messages(T.classify_prompt(labels=NON_NONE))
    x = clauses(spark, d).select("item_id", F.posexplode(msgs).alias("msg_index", "m"))
    return x.select("item_id", F.col("msg_index").cast("int"), "m.role", "m.content")


def q_infer_text(spark, d):
    c = clauses(spark, d)
    conv = T.conversation(T.classify_prompt(labels=NON_NONE, unknown_default="Unknown"))
    return c.select("item_id", T.render_chat(T.flat_turns(conv), add_generation_prompt=True).alias("text"))


def _conv_turns(spark, d):
    return T.turns_from_rows(read_table(spark, d, "conversations"))


def q_chat_text(spark, d):
    t = _conv_turns(spark, d)
    return t.select("conv_id", T.render_chat(F.col("turns")).alias("text"),
                    T.roles_alternate(F.col("turns")).alias("roles_ok"))


TEMPLATES = [
    T.template_row("gemma", T.GEMMA3),
    ("chatml", "", {}, "<|im_start|>", "\n", "<|im_end|>\n", "<|im_start|>assistant\n", "", False, False),
]


def q_chat_templates(spark, d):
    """T6 + T7: rows of one table rendered by the template of their model."""
    t = _conv_turns(spark, d).withColumn("model", F.element_at(F.array(F.lit("gemma"), F.lit("chatml"), F.lit("unknown")),
                                                              (F.col("conv_id") % 3 + 1).cast("int")))
    table = spark.createDataFrame(TEMPLATES, T.TEMPLATE_SCHEMA)
    text = T.render_by_template(t, table, F.col("turns"))
    return T.render_by_template(text, table, F.col("turns"), add_generation_prompt=True, out="prompt").select(
        "conv_id", "model", "text", "prompt")


def q_loss_spans(spark, d):
    """T8 over whole conversations without gathering a conversation in one task."""
    return T.loss_span_rows(read_table(spark, d, "conversations")).select(
        "conv_id", F.col("turn").cast("long").alias("turn"), "span_start", "span_end")


def q_gen_params(spark, d):
    return clauses(spark, d).select("item_id", *T.gen_params())


def q_seq_audit(spark, d):
    return read_table(spark, d, "documents").select(F.col("doc_id").alias("item_id"), *T.seq_audit("text"))


def q_seq_audit_hist(spark, d):
    a = q_seq_audit(spark, d)
    b = F.floor(F.col("est_tokens") / 512).cast("int")
    return a.groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"),
                                            F.count_if("over_budget").alias("over_budget"))


# ------------------------------------------------------------------ I: prediction
class StubPredictor:
    """Deterministic predictor over (item_id, label) batches; fails on chosen rows."""

    def __init__(self, k: int, name: str, fail_mod: int | None = 97):
        self.k, self.name, self.fail_mod = k, name, fail_mod

    def predict(self, pdf):
        from .stub import stub_text
        out = []
        for item_id, label in zip(pdf["item_id"], pdf["label"]):
            if self.fail_mod and item_id % self.fail_mod == 0:
                raise RuntimeError(f"stub predictor failed on item {item_id}")
            out.append(stub_text(int(item_id), None if label is None else str(label), self.k))
        return out


def q_batch_predict(spark, d):
    c = clauses(spark, d).select("item_id", "label")
    parts = [I.batch_predict(c, StubPredictor(k, name)) for k, name in enumerate(X.MODELS)]
    out = parts[0].unionByName(parts[1])
    return out.select("item_id", "model", "response", "error_type")


class StoppingPredictor(StubPredictor):
    """Goes down at the first item whose id's digest, taken modulo 4, is 2 or more."""

    def predict(self, pdf):
        if any(int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) % 4 >= 2 for i in pdf["item_id"]):
            raise I.PredictorDown("no quota left")
        return super().predict(pdf)


def q_predict_resume(spark, d):
    """I1 + I3: the predictor of a first run goes down midway; the second run asks only for
    what the ledger does not hold, and both together give the prediction records."""
    c = clauses(spark, d).select("item_id", "label")
    ledger = os.path.join(checkpoint_dir(spark), f"ledger-{uuid.uuid4().hex}")
    try:
        G.predict_resumable(c, StoppingPredictor(0, CAND), ledger, CAND, n_units=4)
    except PythonException as e:
        if "PredictorDown" not in str(e):
            raise
    got = G.predict_resumable(c, StubPredictor(0, CAND), ledger, CAND, n_units=4)
    records = I.prediction_records(c, got, [CAND])
    return records.join(got.select("item_id", "run"), "item_id", "left").select(
        "item_id", "model", "true_label", "pred_label", "response", "run")


def q_batch_predict_skipped(spark, d):
    c = clauses(spark, d).select("item_id", "label")
    s = I.batch_predict(c, None)
    return Rp.parse_diagnostics(s, labels=NON_NONE).select("item_id", "response", "pred_label", "error_code")


def q_pred_records(spark, d):
    return preds(spark, d)


def q_completion_extract(spark, d):
    c = clauses(spark, d)
    conv = T.conversation(T.classify_prompt(labels=NON_NONE, unknown_default="Unknown"))
    prompt = T.render_chat(T.flat_turns(conv), add_generation_prompt=True)
    r = responses(spark, d).filter(F.col("model") == CAND)
    x = c.select("item_id", prompt.alias("prompt")).join(r, "item_id")
    full = F.concat(F.col("prompt"), F.lit("  "), F.coalesce(F.col("response"), F.lit("")), F.lit("<end_of_turn>"))
    return x.select("item_id", I.completion(full, F.col("prompt")).alias("completion"))


def q_rationale_join(spark, d):
    """Teacher rationale and label per item, joined to the corpus on item_id."""
    c = clauses(spark, d)
    r = responses(spark, d).filter(F.col("model") == BASE)
    p = Rp.parse_simple(r).select("item_id", F.col("rationale").alias("teacher_rationale"),
                                  F.col("label").alias("teacher_label"))
    return c.select("item_id", "split", "label").join(p, "item_id", "left")


class StubTeacher(StubPredictor):
    """A predictor that returns (content, reasoning) pairs."""

    def predict(self, pdf):
        return [(text, None if text is None else f"reasoning {i}") for i, text in zip(pdf["item_id"], super().predict(pdf))]


def q_teacher_collect(spark, d):
    """I1 + I5 as one flow: the teacher's (content, reasoning) collected per item,
    its label and rationale parsed, all joined to the corpus."""
    c = clauses(spark, d)
    got = I.batch_predict(c, StubTeacher(1, BASE), input_cols=["item_id", "label"])
    p = Rp.parse_simple(got.select("item_id", "response", "reasoning")).select(
        "item_id", F.col("reasoning").alias("reasoning_trace"), F.col("label").alias("teacher_label"),
        F.col("rationale").alias("teacher_rationale"))
    return c.select("item_id", "split", "label").join(p, "item_id", "left")


# ------------------------------------------------------------------ R: parsing
def q_parse_simple(spark, d):
    return Rp.parse_simple(responses(spark, d)).select("item_id", "model", "label", "rationale")


def q_parse_strict(spark, d):
    return Rp.parse_strict(responses(spark, d)).select("item_id", "model", "label")


def q_parse_diag(spark, d):
    return Rp.parse_diagnostics(responses(spark, d), labels=NON_NONE).select(
        "item_id", "model", "pred_label", "ok", "error_code", "error_detail", "raw_snippet",
        "json_substring", "parsed_label", "normalized_label")


def q_parse_diag_derived(spark, d):
    """R3 against the labels derived from the base split (L3)."""
    c = clauses(spark, d)
    derived = L.derived_labels(P.base_split(c, names=["train", "validation", "test"]))
    return Rp.parse_diagnostics(responses(spark, d), label_table=derived).select(
        "item_id", "model", "pred_label", "ok", "error_code", "error_detail", "parsed_label", "normalized_label")


def q_parse_diag_many_labels(spark, d):
    """R3 against as many derived labels as there are orders of the first three priorities."""
    o = read_table(spark, d, "orders")
    labels = L.derived_labels(o.filter(F.substring("o_orderpriority", 1, 1) <= "3").select(
        F.concat(F.lit(" order "), F.col("o_orderkey").cast("string")).alias("label")))
    answers = o.select(F.col("o_orderkey").alias("item_id"), F.concat(
        F.lit('{"label": "order '), F.col("o_orderkey").cast("string"), F.lit('"}')).alias("response"))
    return Rp.parse_diagnostics(answers, label_table=labels).select("item_id", "pred_label", "ok", "error_code", "error_detail")


# ------------------------------------------------------------------ E: evaluation
def q_metrics_summary(spark, d):
    return E.summary(pairs(spark, d), is_pairs=True)


def q_metrics_per_class(spark, d):
    return E.per_class_report(pairs(spark, d))


def q_class_report(spark, d):
    return E.class_report(pairs(spark, d))


def q_confusion_fixed(spark, d):
    return E.confusion_fixed(pairs(spark, d))


def q_confusion_used(spark, d):
    p = pairs(spark, d)
    return E.confusion_used(p, L.classes_in_use(p, L.label_dim(spark)), X.MODELS)


def q_metrics_docs(spark, d):
    return E.summary(doc_pairs(spark, d), is_pairs=True)


def q_error_table(spark, d):
    return E.error_rows(preds(spark, d))


def q_error_breakdown(spark, d):
    return E.error_breakdown(pairs(spark, d), 10).select("model", "error_type", "n", F.col("rank").cast("int"))


def q_error_breakdown_first(spark, d):
    """E10 with ties in the order in which the errors appear."""
    p = materialize(E.pair_counts(preds(spark, d), first="item_id"))
    return E.error_breakdown(p, 10, ties="first").select("model", "error_type", "n", "first", F.col("rank").cast("int"))


def q_confusion_wide(spark, d):
    return E.confusion_wide(pairs(spark, d))


SIX = [f"model{k}" for k in range(6)]


def _six(spark, d):
    """Diagnostics of six stub models over every clause."""
    x = clauses(spark, d).select("item_id", "label", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("k"))
    r = x.select("item_id", F.concat(F.lit("model"), F.col("k").cast("string")).alias("model"),
                 X.stub_response(F.col("item_id"), F.col("label"), F.col("k")).alias("response"))
    return Rp.parse_diagnostics(r, labels=NON_NONE)


def q_failing_sets(spark, d):
    return E.failing_sets(parsed(spark, d), X.MODELS)


def q_failing_sets_six(spark, d):
    return E.failing_sets(_six(spark, d), SIX)


def q_error_type_sets(spark, d):
    return E.error_type_sets(pairs(spark, d), X.MODELS)


def q_diag_summary(spark, d):
    return E.diagnostic_summary(parsed(spark, d))


def q_both_failed(spark, d):
    return E.both_failed(parsed(spark, d), X.MODELS)


def q_first_failures(spark, d):
    return E.first_failures(parsed(spark, d), 3).select(
        "model", "item_id", F.col("rank").cast("int"), "error_code", "pred_label", "raw_snippet")


def q_run_summary(spark, d):
    return E.run_summary(E.summary(doc_pairs(spark, d), is_pairs=True), MODEL_META)


def q_run_metadata(spark, d):
    """E14 with the run's own facts: test path, base model, excluded NONE records."""
    counts = Fr.none_filter_counts(clauses(spark, d).filter(F.col("split") == "test"))
    meta = {m: {**f, "base_model": "google/gemma-3-12b-it" if m == CAND else ""} for m, f in MODEL_META.items()}
    return E.run_summary(E.summary(doc_pairs(spark, d), is_pairs=True), meta, excluded=counts,
                         run={"test_data_path": "documents", "timestamp": None}).select(
        "model", "model_path", "accuracy", "excluded_none", "test_data_path", "base_model", "timestamp")


# ------------------------------------------------------------------ C / D
def q_compare_summary(spark, d):
    return C.compare_summary(E.summary(doc_pairs(spark, d), is_pairs=True), CAND, BASE)


def q_compare_metrics(spark, d):
    return C.compare_metrics(E.summary(pairs(spark, d), is_pairs=True), CAND, BASE)


def q_error_overlap(spark, d):
    return C.error_type_overlap(pairs(spark, d), CAND, BASE)


def q_aligned(spark, d):
    return C.aligned(diag(spark, d).select("item_id", "model", "true_label", "pred_label", "ok"), BASE, CAND)


def q_dist_none(spark, d):
    return C.none_distribution(clauses(spark, d))


def q_dist_labels(spark, d):
    return C.label_distribution(clauses(spark, d))


def q_dist_splits(spark, d):
    return C.split_distribution(clauses(spark, d))


def q_step_estimate(spark, d):
    return C.step_estimate(clauses(spark, d))


# ------------------------------------------------------------------ S: sources / sinks
def q_split_manifest(spark, d):
    c = clauses(spark, d).select("item_id", "split", "clause", "clause_with_context", "contract_type",
                                 "label", "rationale")
    return S.split_manifest(c)


def q_jsonl_roundtrip(spark, d):
    """Write per-split JSONL, read it back strictly, return the rows."""
    c = clauses(spark, d)
    out = os.path.join(checkpoint_dir(spark), f"jsonl-{uuid.uuid4().hex}")
    S.write_jsonl(c, out, overwrite=True)
    parts = [S.read_jsonl(spark, p) for p in S.require_splits(spark, out, ("train", "validation", "test")).values()]
    r = parts[0]
    for p in parts[1:]:
        r = r.unionByName(p)
    return r.select("item_id", "split", "clause", "contract_type", "label", "rationale")


def q_jsonl_guard(spark, d):
    """S3 + S4: 67 splits and a null one are written by one job; a second write into
    the same folder is refused as a whole and leaves the first one's rows."""
    c = clauses(spark, d).select("item_id", F.when(F.col("item_id") % 68 < 67, F.concat(
        F.lit("s"), (F.col("item_id") % 68).cast("string"))).alias("split"))
    out = os.path.join(checkpoint_dir(spark), f"guard-{uuid.uuid4().hex}")
    first = S.write_jsonl(c, out)
    again = S.write_jsonl(c.withColumn("split", F.lit("other")), out)
    rows = S.read_jsonl(spark, S.full_path(spark, out), "item_id long, split string")
    return rows.select("item_id", "split", F.lit(first).alias("wrote_first"), F.lit(again).alias("wrote_again"))


def q_jsonl_publish(spark, d):
    """S3 + S4: splits with any name keep every row; a second committed write replaces the
    first, and each row comes from the folder of its own split."""
    names = F.array(*map(F.lit, ODD_SPLITS), F.lit(None))
    c = clauses(spark, d).select("item_id", F.element_at(names, (F.col("item_id") % (len(ODD_SPLITS) + 1) + 1).cast("int")).alias("split"),
                                 "label")
    out = os.path.join(checkpoint_dir(spark), f"publish-{uuid.uuid4().hex}")
    S.write_jsonl(c.withColumn("label", F.lit("first")), out)
    S.write_jsonl(c, out, overwrite=True)
    rows = None
    for split, path in S.split_paths(spark, out).items():
        own = S.read_jsonl(spark, path, "item_id long, split string, label string").withColumn("read_from", F.lit(split).cast("string"))
        rows = own if rows is None else rows.unionByName(own)
    return rows


def q_jsonl_ingest(spark, d):
    """S1 + S6: write the corpus as JSONL, then ingest it strictly to Parquet in one pass."""
    c = clauses(spark, d)
    base = os.path.join(checkpoint_dir(spark), f"ingest-{uuid.uuid4().hex}")
    S.write_jsonl(c, base, overwrite=True)
    out = S.ingest_jsonl(spark, S.full_path(spark, base), f"{base}/parquet")
    return out.select("item_id", "split", "clause", "contract_type", "label", "rationale")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Entry query: per-class precision / recall / F1 of both models on the clause corpus."""
    return E.per_class_report(doc_pairs(spark, d))
