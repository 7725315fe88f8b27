"""Mixing against a plain version of the target rule, and the dual's optimum."""

import random

import numpy as np
import pytest

from labelforge.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, target string, rate string"


def plain_targets(sizes):
    """Targets by the rule: order, weights, share, ceiling, reshared excess."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-8")) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, total, out = set(names), 1.5 * sum(sizes.values()), {}
    while left:
        unit = total / sum(weight[s] for s in left)
        over = {s for s in left if unit * weight[s] > 2 * sizes[s]}
        if not over:
            out.update({s: unit * weight[s] for s in left})
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
            total -= out[s]
        left -= over
    return out


def corpus(seed=2):
    r = random.Random(seed)
    rows = []
    for k in range(900):
        source = r.choice(["hot"] * 6 + ["b", "é", "Z", None, "日", "x"])
        rows.append((k, " ".join(["w"] * r.choice([1, 5, 30, 80, 200])), source))
    rows += [(1000, None, "hot"), (1001, "", "nothing"), (1002, "w " * 5000, "hot"), (1003, "a b c", "b")]
    return rows


@pytest.fixture(scope="module")
def mixed(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, "s", "t", "r") for r in rows], SCHEMA).repartition(4)
    return rows, df, mixing.rates(df).collect()


def test_sizes_and_targets_follow_the_rule(mixed):
    rows, _, got = mixed
    text = {i: t for i, t, _ in rows}
    sizes = {}
    for i, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").encode().split())
    want = plain_targets(sizes)
    assert len(got) == len(rows)
    for r in got:
        assert r["size"] == len((text[r["doc_id"]] or "").encode().split())
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]


def test_taken_words_come_near_the_target(mixed):
    _, _, got = mixed
    for s in {r["source"] for r in got}:
        own = [r for r in got if r["source"] == s]
        largest = max(r["size"] for r in own)
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= largest


def test_rates_are_exponentially_tilted_and_meet_the_constraint(mixed):
    _, _, got = mixed
    own = [r for r in got if r["source"] == "hot" and r["size"]]
    mean = own[0]["source_size"] / sum(r["source"] == "hot" for r in got)
    assert abs(sum(r["rate"] * r["size"] for r in own) - own[0]["target"]) < 1e-3
    free = [r for r in own if 1e-9 < r["rate"] < 2]
    tilt = [np.log(r["rate"]) / (r["size"] / mean) for r in free]
    assert len(free) > 10 and np.ptp(tilt) < 1e-6


def test_reruns_agree_and_copies_are_rows(spark, mixed):
    _, df, got = mixed
    again = {r["doc_id"]: r["taken"] for r in mixing.rates(df.repartition(9)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in got}
    out = mixing.mix(df)
    assert out.columns == df.columns
    count = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert count == {r["doc_id"]: r["copies"] for r in got if r["copies"]}


def test_every_column_is_bit_equal_however_rows_are_partitioned(spark, mixed):
    _, df, _ = mixed
    runs = [sorted(map(tuple, mixing.rates(df.repartition(n)).collect()), key=repr) for n in (1, 4, 7)]
    assert "rate" in mixing.rates(df).columns and runs[0] == runs[1] == runs[2]


def test_null_and_repeated_rows_and_empty_tables(spark):
    rows = [(None, "a b c", None), (1, "a b", "s"), (1, "a b", "s"), (2, None, None)]
    df = spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA)
    got = mixing.rates(df).collect()
    assert len(got) == 4 and len({r["copies"] for r in got if r["doc_id"] == 1}) == 1
    assert mixing.mix(df).count() == sum(r["copies"] for r in got)
    assert mixing.rates(df.limit(0)).collect() == [] and mixing.mix(df.limit(0)).collect() == []
    silent = spark.createDataFrame([(1, "", "s", "", "", "")], SCHEMA)
    assert [r["taken"] for r in mixing.rates(silent).collect()] == [0]


def test_mix_shuffles_no_texts(spark, tmp_path):
    words = "alpha beta\tgamma\x0bdelta\n \x0c epsilon\r x  y\x1cz"
    rows = [(i, words * (1 + i % 7) if i % 9 else None, f"s{i % 3}", "", "", "") for i in range(6000)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/d")
    df = spark.read.parquet(f"{tmp_path}/d")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "30k")       # holds the sources, not the documents
    try:
        out = mixing.mix(df)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    copies = {r["doc_id"]: r["copies"] for r in mixing.rates(df).collect()}
    assert {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()} == {i: n for i, n in copies.items() if n}
