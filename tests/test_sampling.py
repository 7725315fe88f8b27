"""Sampling and splitting: deterministic under any partitioning, exact sizes."""

import math

from pyspark.sql import functions as F

from labelforge.operators import metrics as E
from labelforge.operators import ranking
from labelforge.operators import sampling as P
from labelforge.plans import queries as Q

from .conftest import SF_SMALL


def _ids(df):
    return sorted(tuple(r) for r in df.collect())


def test_sample_and_splits_invariant_under_repartition(spark):
    c = Q.clauses(spark, SF_SMALL)
    outs = []
    for n in (1, 7, 64):
        x = c.repartition(n)
        outs.append((_ids(P.sample_eval(x, 50, True, True, 42).select("item_id")),
                     _ids(P.split_hash(x.select("item_id"), 0.1, 42)),
                     _ids(P.split_exact(x.select("item_id"), 0.1, 42))))
    assert outs[0] == outs[1] == outs[2]


def test_exact_split_size(spark):
    c = Q.clauses(spark, SF_SMALL).select("item_id")
    s = P.split_exact(c, 0.1, 42)
    n = c.count()
    assert s.filter(F.col("role") == "validation").count() == math.ceil(0.1 * n)
    assert s.count() == n


def test_first_k_equals_a_sort_at_every_k(spark):
    c = Q.clauses(spark, SF_SMALL).select("item_id")
    for k in (1, 37, 200, 1000):
        want = _ids(c.orderBy("item_id").limit(k))
        assert _ids(ranking.first_k(c.repartition(5), ["item_id"], k, ranking.number_bucket("item_id"))) == want
    one = spark.createDataFrame([(7,)], "item_id long")
    assert _ids(ranking.first_k(one, ["item_id"], 1, ranking.number_bucket("item_id"))) == [(7,)]
    assert _ids(ranking.first_k(one.limit(0), ["item_id"], 1, ranking.number_bucket("item_id"))) == []


def test_cap_keeps_every_split_name(spark):
    from labelforge.operators import records as Fr
    rows = [(i, s) for i, s in enumerate(["train", "val", None, "odd"] * 5)]
    df = spark.createDataFrame(rows, "item_id long, split string")
    assert Fr.cap_first_n(df, 100).count() == 20
    got = Fr.cap_first_n(df, 2).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in got} == {"train": 2, "val": 2, None: 2, "odd": 2}


def test_split_hash_at_both_ends(spark):
    c = Q.clauses(spark, SF_SMALL).select("item_id")
    for share, want in ((0.0, {"train"}), (1.0, {"validation"})):
        assert {r["role"] for r in P.split_hash(c, share).select("role").distinct().collect()} == want
        assert {r["role"] for r in P.split_exact(c, share).select("role").distinct().collect()} == want


def test_one_dataset_without_splits_is_carved(spark):
    c = Q.clauses(spark, SF_SMALL).select("item_id")
    assert _ids(P.resolve_splits(c)) == _ids(P.split_hash(c))


def test_unseeded_shuffle_records_seed(spark):
    c = Q.clauses(spark, SF_SMALL)
    s = P.sample_eval(c, 5, True, True, None)
    assert s.select("seed").distinct().count() == 1


def test_resolve_splits_carves_validation(spark):
    c = Q.clauses(spark, SF_SMALL).filter("split = 'train'").select("item_id", "split")
    r = P.resolve_splits(c)
    roles = {row["role"] for row in r.collect()}
    assert roles == {"train", "validation"}


def test_topk_window_invariant(spark):
    d = Q.diag(spark, SF_SMALL)
    a = _ids(E.first_failures(d.repartition(3), 3).select("model", "item_id"))
    b = _ids(E.first_failures(d.repartition(17), 3).select("model", "item_id"))
    assert a == b and len(a) == 6


def test_cap_modes(spark):
    from labelforge.operators import records as Fr
    c = Q.clauses(spark, SF_SMALL)
    assert Fr.cap_first_n(c, 0, mode="pipeline").count() == c.count()      # 0 = no cap
    assert Fr.cap_first_n(c, 0, mode="notebook").count() == 0              # 0 = empty
    capped = Fr.cap_first_n(c, 3)
    assert {r["split"]: r["n"] for r in capped.groupBy("split").agg(F.count("*").alias("n")).collect()} == \
        {"train": 3, "validation": 3, "test": 3}


def _largest_rank_task(spark, monkeypatch):
    """Records how many keys each final ranking holds per group."""
    seen = []
    real = ranking.materialize

    def note(df):
        out = real(df)
        if "_need" in out.columns:
            seen.append([r["_n"] for r in out.select("_n").collect()])
        return out
    monkeypatch.setattr(ranking, "materialize", note)
    return seen


def test_cut_offs_under_outlying_keys_and_a_hot_group(spark, monkeypatch):
    """One id of 2^62 among small ones, 95 % of the rows in one group, nulls and keys that
    lie apart like powers of two: the last ranges hold few keys and the cut-off is exact."""
    monkeypatch.setattr(ranking, "RANKED", 40)
    monkeypatch.setattr(ranking, "CELLS", 16)
    monkeypatch.setattr(ranking, "HEAD", 0)
    seen = _largest_rank_task(spark, monkeypatch)
    rows = [(i * 3, "hot") for i in range(3000)] + [(2**62, "hot"), (-2**63, "hot"), (2**63 - 1, "hot")]
    rows += [(1 + 3 * i, "cold") for i in range(50)] + [(2**i, "powers") for i in range(62) if 2**i % 3 != 0]
    rows += [(2**i + 1, "powers") for i in range(3, 62)] + [(-i, None) for i in range(1, 80)]
    df = spark.createDataFrame(rows, "item_id long, split string").repartition(5)
    want = {}
    for i, g in sorted(rows, key=lambda r: r[0]):
        want.setdefault(g, []).append(i)
    for k in (1, 45, 77, 2999):
        seen.clear()
        got = ranking.first_k(df, ["item_id"], k, ranking.number_bucket("item_id"), by=["split"])
        have = {}
        for r in got.collect():
            have.setdefault(r["split"], []).append(r["item_id"])
        assert {g: sorted(v) for g, v in have.items()} == {g: v[:k] for g, v in want.items()}
        assert max(seen[-1], default=0) <= 40
    x = P.with_shuffle_key(df.drop("split").dropDuplicates(), 42)
    order = sorted(x.select("shuffle_key", "item_id").collect())
    got = ranking.first_k(x, ["shuffle_key", "item_id"], 700, ranking.hex_bucket("shuffle_key"))
    assert sorted(got.select("shuffle_key", "item_id").collect()) == order[:700]


def test_cut_offs_with_null_keys_and_many_equal_ones(spark, monkeypatch):
    monkeypatch.setattr(ranking, "RANKED", 10)
    monkeypatch.setattr(ranking, "CELLS", 4)
    rows = [(None, i) for i in range(60)] + [(5, i) for i in range(100)] + [(6, i) for i in range(7)]
    df = spark.createDataFrame(rows, "a long, b long").repartition(4)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for k in (3, 60, 61, 150, 166, 167):
        got = ranking.cutoffs(df, ["a", "b"], ranking.number_bucket("a"), lambda total: F.lit(k)).collect()
        assert [tuple(r["_cut"]) for r in got] == [order[k - 1]]
    assert ranking.cutoffs(df, ["a", "b"], ranking.number_bucket("a"), lambda total: F.lit(168)).collect() == []
    alike = spark.createDataFrame([(1,)] * 50, "a long")
    assert [tuple(r["_cut"]) for r in ranking.cutoffs(alike, ["a"], ranking.number_bucket("a"), lambda t: F.lit(30)).collect()] == [(1,)]


def test_shuffled_positions_are_dense_and_the_same_at_any_partitioning(spark):
    c = Q.clauses(spark, SF_SMALL).select("item_id", "split")
    outs = [{r["item_id"]: r["position"] for r in P.shuffled(c.repartition(n), 42, n).collect()} for n in (1, 3, 11)]
    assert outs[0] == outs[1] == outs[2] and sorted(outs[0].values()) == list(range(len(outs[0])))
    by_key = [r["item_id"] for r in P.with_shuffle_key(c, 42).orderBy("shuffle_key", "item_id").collect()]
    assert sorted(outs[0], key=outs[0].get) == by_key
    assert P.shuffled(c.limit(0), 42).collect() == []


def test_split_resolution_with_any_number_of_splits(spark):
    rows = [(i, f"s{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "item_id long, split string")
    assert {r["item_id"] for r in P.resolve_splits(df).collect()} == {0}
    more = df.unionByName(spark.createDataFrame([(500, "train"), (501, "val"), (502, "test")], df.schema))
    assert {(r["item_id"], r["role"]) for r in P.resolve_splits(more).collect()} == {(500, "train"), (501, "validation")}
    assert [r["item_id"] for r in P.base_split(more).collect()] == [502]
    assert P.resolve_splits(df.limit(0)).collect() == [] and P.base_split(df.limit(0)).collect() == []
