"""The pipeline against a plain version of its stages, and its registration."""

import random

import pytest
import tiktoken

import corpus_pipeline
from labelforge.llm import bpe, mixing, pii, quality
from labelforge.llm.queries import QUERIES, tokenizer

from .test_neardup import brute
from .test_pii import reference

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    r = random.Random(11)
    stock = {"en": "the of and to in is it for on with".split(), "de": "der die das und von zu mit den ist im".split()}

    def text(lang, n):
        return " ".join(r.choice(stock[lang]) if r.random() < 0.4 else "".join(r.choice("abcdefghilmnoprst") for _ in range(6))
                        + ("." if r.random() < 0.1 else "") for _ in range(n))
    rows = []
    for k in range(120):
        lang = ("en", "de")[k % 2]
        rows.append([k, text(lang, r.choice([70, 120, 300])), lang, f"s{k % 4}"])
    for k in range(200, 212):                              # copies and near copies
        w = rows[3][1].split()
        if k % 2:
            w[r.randrange(len(w))] = "edited"
        rows.append([k, " ".join(w), "de", "s1"])
    rows[5][1] += " mail bob@ex.org or call +49 (151) 234-5678 now"
    rows += [[300, None, "en", "s0"], [301, "", "en", None], [302, "too short", None, "s2"], [303, "again " * 500, "en", "s0"],
             [304, "BUY!! NOW$$ " * 40, "en", "s3"], [305, text("en", 30_000), "en", None]]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    d = f"file://{tmp_path_factory.mktemp('tables')}"
    spark.createDataFrame(corpus(), SCHEMA).repartition(4).write.parquet(f"{d}/documents.parquet")
    docs, out = spark.read.parquet(f"{d}/documents.parquet"), []
    for name, step in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(step(spark, docs, d), name)
        out.append((name, docs, [r.asDict() for r in docs.collect()]))
    return d, out


def test_stages_are_in_order_and_keep_the_columns(staged):
    _, out = staged
    assert [n for n, _, _ in out] == ["quality_rules", "near_dedup", "pii_redaction", "source_mix", "bpe_tokens"]
    for _, df, _ in out[:-1]:
        assert df.columns == COLUMNS
    assert out[-1][1].columns == ["doc_id", "lang", "source", "n_chars", "n_tokens", "ids"]


def test_each_stage_equals_its_plain_version(spark, staged):
    d, out = staged
    tables = [[dict(zip(COLUMNS, r)) for r in corpus()], *[rows for _, _, rows in out]]
    kept = {r["doc_id"] for r in quality.score(spark.read.parquet(f"{d}/documents.parquet")).collect() if r["kept"]}
    assert {r["doc_id"] for r in tables[1]} == kept and not kept & {300, 301, 302, 303, 304} and len(kept) > 120
    links = brute([(r["doc_id"], r["text"]) for r in tables[1]], 5, 80, 100)
    assert {r["doc_id"] for r in tables[2]} == {i for i, (_, _, first) in links.items() if first}
    assert not {r["doc_id"] for r in tables[2]} & set(range(200, 212))
    before = {r["doc_id"]: r["text"] for r in tables[2]}
    for r in tables[3]:
        want = pii.redacted(before[r["doc_id"]], reference(before[r["doc_id"]]))
        assert r["text"] == want and r["n_chars"] == len(want)
    assert any("[EMAIL]" in r["text"] and "[PHONE]" in r["text"] for r in tables[3])
    copies = {r["doc_id"]: r["copies"] for r in mixing.rates(spark.createDataFrame(tables[3], SCHEMA)).collect()}
    got = {}
    for r in tables[4]:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == {i: n for i, n in copies.items() if n}
    path, pattern = tokenizer()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    text = {r["doc_id"]: r["text"] for r in tables[4]}
    assert sorted(r["doc_id"] for r in tables[5]) == sorted(r["doc_id"] for r in tables[4])
    for r in tables[5]:
        assert list(r["ids"]) == library.encode_ordinary(text[r["doc_id"]]) and r["n_tokens"] == len(r["ids"])


def test_run_equals_the_stages_one_by_one(spark, staged):
    d, out = staged
    got = sorted((r["doc_id"], list(r["ids"])) for r in corpus_pipeline.run(spark, d).collect())
    assert got == sorted((r["doc_id"], list(r["ids"])) for r in out[-1][2])


def test_empty_tables_and_extra_columns_pass_every_stage(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA + ", size string, kept string, node string")
    for _, step in corpus_pipeline.STAGES:
        got = step(spark, empty, f"file://{tmp_path}")
        assert got.count() == 0
        if "text" in got.columns:
            assert got.columns == empty.columns


def test_entry_registers_every_operator_and_the_pipeline():
    import __spark_entry__ as entry
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
