"""Lloyd's rounds against a plain version in Python integers."""

import hashlib
import math

import numpy as np
import pytest

from labelforge.llm import lloyd

SCHEMA = "vec_id long, embedding array<double>, cluster int, distance string"


def plain(rows, k, dim, rounds, seed=2):
    good = [(i, [math.floor(256 * x) if math.isfinite(256 * x) else 256 * int(x) for x in v], v) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(good, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[2]))
    centres = [r[1] for r in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        own = [[] for _ in centres]
        for _, v, _ in good:
            own[nearest(v)[1]].append(v)
        centres = [[sum(x) // len(vs) for x in zip(*vs)] if vs else c for vs, c in zip(own, centres)]
    found = [(i, *nearest(v)) for i, v, _ in good]
    small = lambda x: x if x < 2**63 else None                                             # noqa: E731
    total = {j: sum(d for _, d, c in found if c == j) for j in range(len(centres))}
    return [(i, j, small(d), small(total[j]), small(sum(total.values())),
             hashlib.sha256(",".join(map(str, centres[j])).encode()).hexdigest()) for i, d, j in found]


def key(r):
    return [(x is None, x or 0) for x in r[:5]]


@pytest.mark.parametrize(("n", "k", "dim", "shards", "chunk"), [(400, 7, 6, 4, 50), (300, 40, 5, 2, 4096), (5, 9, 3, 3, 2), (90, 3, 2, 1, 7)])
def test_equals_a_plain_version(spark, monkeypatch, n, k, dim, shards, chunk):
    monkeypatch.setattr(lloyd, "CHUNK", chunk)
    r = np.random.default_rng(n)
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(r.permutation(3 * n), r.normal(size=(n, dim)))]
    rows += [(7, rows[0][1])] * 30 + [(8, rows[1][1]), (8, rows[2][1]), (None, rows[0][1]), (None, [-0.5] * dim)]    # copies, ties
    rows += [(1, None), (2, []), (3, [1.0] * (dim + 1)), (4, [float("nan")] * dim), (5, [float("-inf")] * dim), (6, [None] * dim)]
    df = spark.createDataFrame([(*x, 1, "d") for x in rows], SCHEMA).repartition(5)
    got = [tuple(x) for x in lloyd.report(df, k=k, dim=dim, rounds=4, shards=shards).collect()]
    assert sorted(got, key=key) == sorted(plain(rows, k, dim, 4), key=key)


def test_numbers_beyond_64_bits_stay_exact(spark):
    r = np.random.default_rng(1)
    scale = [1e-320, 1.0, 1e6, 1e12, 1e17, 1e150, 1.7e308]
    rows = [(i, [float(x) * scale[i % 7] for x in r.uniform(-1, 1, 4)]) for i in range(60)]
    df = spark.createDataFrame([(*x, 1, "d") for x in rows], SCHEMA).repartition(3)
    got = [tuple(x) for x in lloyd.report(df, k=5, dim=4, rounds=3, shards=2).collect()]
    assert sorted(got, key=key) == sorted(plain(rows, 5, 4, 3), key=key)


def test_an_empty_table_and_no_usable_vector(spark):
    for rows in ([], [(1, None), (2, [1.0])]):
        df = spark.createDataFrame([(*x, 1, "d") for x in rows], SCHEMA)
        out = lloyd.report(df, k=3, dim=2)
        assert out.collect() == []
        assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
