"""Nearest neighbours against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelforge.llm import vptree

SCHEMA = "vec_id long, embedding array<float>, score double, rank int, query_id long"


def vectors(n=700, dim=6, seed=1):
    r = np.random.default_rng(seed)
    v = r.normal(size=(n, dim)).astype(np.float32) * r.uniform(0.2, 3, (n, 1)).astype(np.float32)
    v[100:180] = v[7]                                     # many copies of one vector
    v[200:203] = v[9]
    return v


def brute(rows, k):
    """The lists of (rank, vec_id, score) of every query row, by id."""
    good = [(i, v) for i, v in rows if not (i is None or v is None or not len(v) or any(x is None or not math.isfinite(x) for x in v)
                                            or not any(v))]
    out = {}
    for at, (q, own) in enumerate(good):
        if q % 20:
            continue
        scored = []
        for n, (i, v) in enumerate(good):
            if n != at and len(v) == len(own):
                s = 0.0
                for a, b in zip(own, v):
                    s += a * b
                scored.append((-s, i))
        out.setdefault(q, []).extend((r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1))
    return out


def test_factor_one_is_exact(spark):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors())]
    nan, inf = float("nan"), float("inf")
    rows += [(1000, None), (1020, []), (1040, [0.0] * 6), (1060, [nan] + [1.0] * 5), (1080, [inf] + [1.0] * 5),
             (1100, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (None, [1.0] * 6), (1120, [1.0, 2.0]), (1121, [2.0, 1.0]), (1140, [5.0]),
             (1160, [1.0] * 6), (1160, [1.0] * 6), (1160, [0.5, 0.25] * 3), (7, [1.0] * 6), (7, [2.0] * 6), (-20, [0.5] * 6)]
    df = spark.createDataFrame([(*r, 0.5, 1, 2) for r in rows], SCHEMA).repartition(4)
    got = {}
    for r in vptree.nearest(df, F.col("vec_id") % 20 == 0, k=20, shard=150, block=13).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = {q: sorted(v) for q, v in brute(rows, 20).items() if v}
    assert want == {q: sorted(v) for q, v in got.items()} and len(want[1160]) == 60
    assert 1140 not in got and len(got[1120]) == 1
    assert vptree.nearest(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []


@pytest.mark.parametrize("factor", [1.0, 2.0, 4.0])
def test_a_larger_factor_looks_at_less_and_keeps_recall(factor):
    r = np.random.default_rng(5)
    centres = r.normal(size=(40, 8))
    v = (centres[r.integers(0, 40, 4000)] + 0.05 * r.normal(size=(4000, 8))).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    ids = np.arange(4000)
    tree = vptree.build(ids, v, 10)
    q, found, score, looked = vptree.search(tree, ids[::20], v[::20], 10, factor)
    exact = v[::20].astype(float) @ v.astype(float).T
    exact[np.arange(200), ids[::20]] = -np.inf
    want = np.sort(-exact, 1)[:, :10]
    hits = (score.reshape(200, 10) >= -want[:, 9:10] - 1e-9).mean()
    assert hits == 1.0 if factor == 1.0 else hits >= 0.9
    assert looked < 200 * 4000 * 0.1
    if factor > 1:
        assert looked < vptree.search(tree, ids[::20], v[::20], 10, 1.0)[3] * 0.7


@pytest.mark.parametrize("kind", ["one-hot", "binary", "rounded"])
def test_of_many_vectors_with_equal_scores_the_smallest_ids_stay(kind):
    """Hundreds of distinct vectors are tied at the last rank."""
    r = np.random.default_rng(8)
    n, dim, k = 900, 1000, 20
    if kind == "one-hot":
        v = np.eye(n, dim, dtype=np.float32)
        v[:30, 999] = 1                                     # 30 that are near one another
    elif kind == "binary":
        v = (r.random((n, 12)) < 0.5).astype(np.float32)
        v[:, 0] = 1
    else:                                                   # equal scores up to rounding, by products in other orders
        base = r.normal(size=12).astype(np.float32)
        v = np.stack([base[r.permutation(12)] for _ in range(n)])
        v[::20] = np.float32(0.1)
    ids = r.permutation(5 * n)[:n]
    tree = vptree.build(ids, v, k)
    q, found, score, _ = vptree.search(tree, ids[::20], v[::20], k, 1.0)
    w = v.astype(np.float64)
    for i in range(0, n, 20):
        exact = np.cumsum(w * w[i], axis=1)[:, -1]
        want = sorted((-s, int(x)) for s, x in zip(exact, ids) if x != ids[i])[:k]
        assert [(-s, x) for s, x in zip(score[q == ids[i]], found[q == ids[i]])] == want
