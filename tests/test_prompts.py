"""Prompt / SFT / chat bytes against goldens built with a standard JSON writer."""

import json

import pytest
from pyspark.sql import functions as F

from labelforge.functions.constants import (CLASSIFY_INSTRUCTIONS, LABEL_SCHEMA, SCHEMA_LABEL_DESC,
                                            SCHEMA_RATIONALE_DESC)
from labelforge.operators import prompts as T

ROW = ("  Company may terminate this Agreement at any time. ",
       "Section 8. Termination. Company may \"terminate\" — à tout moment.\n\tEnd/",
       "  ", "Termination for Convenience", "  Because it lets a party exit. ")


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([ROW], "clause string, clause_with_context string, contract_type string, "
                                        "label string, rationale string")


def test_classify_prompt_golden(df):
    labels = [x for x in LABEL_SCHEMA if x != "NONE"]
    want = json.dumps({"task": "classify_legal_clause", "instructions": CLASSIFY_INSTRUCTIONS,
                       "schema": {"rationale": SCHEMA_RATIONALE_DESC, "label": SCHEMA_LABEL_DESC},
                       "valid_labels": labels,
                       "inputs": {"clause": ROW[0].strip(), "clause_with_context": ROW[1].strip(),
                                  "contract_type": "Unknown"}}, ensure_ascii=False)
    got = df.select(T.classify_prompt(labels=labels, unknown_default="Unknown")).first()[0]
    assert got == want


def test_sft_target_golden(df):
    want = json.dumps({"rationale": ROW[4].strip(), "label": ROW[3]}, ensure_ascii=False)
    assert df.select(T.sft_target()).first()[0] == want


def test_target_label_rules(spark):
    d = spark.createDataFrame([(None,), ("",), ("  ",), (" x ",)], "label string")
    assert [r[0] for r in d.select(T.target_label()).collect()] == ["NONE", "NONE", "", "x"]


CHATS = {
    "single": ([("user", "Hi")], "<bos><start_of_turn>user\nHi<end_of_turn>\n", []),
    "three": ([("user", "Q1"), ("assistant", " A1 "), ("user", "Q2")],
              "<bos><start_of_turn>user\nQ1<end_of_turn>\n<start_of_turn>model\nA1<end_of_turn>\n"
              "<start_of_turn>user\nQ2<end_of_turn>\n", ["A1<end_of_turn>\n"]),
    "system": ([("system", "Be brief."), ("user", "Q"), ("assistant", "A")],
               "<bos><start_of_turn>user\nBe brief.\n\nQ<end_of_turn>\n<start_of_turn>model\nA<end_of_turn>\n",
               ["A<end_of_turn>\n"]),
}


@pytest.mark.parametrize("name", sorted(CHATS))
def test_chat_goldens_and_spans(spark, name):
    turns, text, trained = CHATS[name]
    d = spark.createDataFrame([(turns,)], "turns array<struct<role:string,text:string>>")
    r = d.select(T.render_chat(F.col("turns")).alias("t"), T.loss_spans(F.col("turns")).alias("s"),
                 T.roles_alternate(F.col("turns")).alias("ok")).first()
    assert r["t"] == text and r["ok"]
    assert [r["t"][s["start"]:s["end"]] for s in r["s"]] == trained


def test_generation_prompt(spark):
    d = spark.createDataFrame([([("user", "Q")],)], "turns array<struct<role:string,text:string>>")
    t = d.select(T.render_chat(F.col("turns"), add_generation_prompt=True)).first()[0]
    assert t.endswith("<end_of_turn>\n<start_of_turn>model\n")


def test_ensure_text_rerenders_token_ids(spark):
    conv = [("user", [("text", "Q")]), ("assistant", [("text", "A")])]
    d = spark.createDataFrame([([1, 2, 3], conv)],
                              "text array<int>, conversations array<struct<role:string,"
                              "content:array<struct<type:string,text:string>>>>")
    out = T.ensure_text(d).first()["text"]
    assert out.startswith("<bos><start_of_turn>user\nQ")


def test_gen_params_defaults_and_overrides(spark):
    d = spark.createDataFrame([(None, None, 0.5)], "model string, temperature double, top_p double")
    r = d.select(*T.gen_params()).first()
    assert (r["model"], r["temperature"], r["top_p"], r["max_tokens"]) == ("deepseek/deepseek-r1", 0.6, 0.5, 1500)
    r2 = d.select(*T.gen_params({"temperature": 0.1})).first()
    assert r2["temperature"] == 0.1


def test_rows_take_the_template_of_their_model(spark):
    turns = [("system", " be brief "), ("user", " hi "), ("assistant", "yo"), ("tool", "x")]
    table = spark.createDataFrame([
        T.template_row("a", T.GEMMA3),
        ("b", "^", {"user": "U:", "assistant": "A:"}, "[", "]", "|", "A:", "+", False, False),
        ("c", "", {"user": "U:"}, "<", ">", ";", "G", "/", True, True)], T.TEMPLATE_SCHEMA)
    rows = [(i, m, turns) for i, m in enumerate(["a", "b", "c", "none"])]
    df = spark.createDataFrame(rows, "id int, model string, turns array<struct<role:string,text:string>>")
    got = {r["id"]: r for r in T.render_by_template(df, table, F.col("turns"), add_generation_prompt=True).collect()}
    plain = spark.createDataFrame([(turns,)], "turns array<struct<role:string,text:string>>")
    assert got[0]["text"] == plain.select(T.render_chat(F.col("turns"), add_generation_prompt=True)).first()[0]
    assert got[1]["text"] == "^[system] be brief |U: hi |A:yo|[tool]x|A:"
    assert got[2]["text"] == "U:be brief/hi;<assistant>yo;<tool>x;G"
    assert got[3]["text"] is None and set(got[0].asDict()) == {"id", "model", "turns", "text"}
