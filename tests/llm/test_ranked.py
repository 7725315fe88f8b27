"""Ranked search against a plain scan over all documents."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from labelforge.llm import ranked

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    return TERM.findall(re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))


def brute(docs, items, k):
    """{place of item: [(rank, doc_id, score)]}."""
    own = [(i, Counter(w), len(w)) for i, t in docs if (w := words(t))]
    n_docs, n_terms = len(own), sum(n for *_, n in own)
    df = Counter(t for _, c, _ in own for t in c)
    out = {}
    for place, (_, text) in enumerate(items):
        scored = []
        for i, c, n in own:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                    for t in words(text) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out[place] = [(r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return out


def corpus(n=700, seed=2):
    r = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(60)] + ["Ñu", "ñu", "日本", "x1", "Ab", "aB"]
    p = 1 / np.arange(1, len(base) + 1)
    docs = [(int(i), " ".join(r.choice(base, r.integers(1, 60), p=p / p.sum()))) for i in r.permutation(n * 3)[:n]]
    docs += [(5000 + i, "w1 w2 w3 w1, w40") for i in range(150)]                # ties
    docs += [(9, None), (10, ""), (11, " .,!"), (None, "w50 w51"), (12, "w50 w51"), (12, "w50 w51"), (13, "w3 " * 5000),
             (14, "a_b a-b\x7fb À,á\xa0b e·f")]
    items = [(i, " ".join(r.choice(base, r.integers(1, 12)))) for i in range(40)]
    items += [(3, "w1 W40 w40"), (100, None), (101, ""), (102, "nowhere"), (103, "w50 w51 W50"), (104, "a b À e·f á\xa0b"), (None, "w3")]
    return docs, items


@pytest.mark.parametrize(("shard", "postings", "block"), [(100_000, 10**9, 1000), (64, 10**9, 7), (50, 300, 1000)])
def test_equals_a_scan(spark, monkeypatch, shard, postings, block):
    monkeypatch.setattr(ranked, "SHARD", shard)
    monkeypatch.setattr(ranked, "POSTINGS", postings)
    monkeypatch.setattr(ranked, "ITEMS", block)
    docs, items = corpus()
    left = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, score int, item_id string").repartition(3)
    right = spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, rank int").coalesce(1)
    got = [tuple(r) for r in ranked.rank(left, right, k=9).collect()]
    want = [(items[p][0], *row) for p, rows in brute(docs, items, 9).items() for row in rows]
    order = lambda r: [(x is None, x or 0) for x in r]                                     # noqa: E731
    assert sorted(got, key=order) == sorted(want, key=order)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked.rank(docs.limit(0), items).collect() == []
    assert ranked.rank(docs, items.limit(0)).collect() == []
    assert [tuple(r)[:3] for r in ranked.rank(docs, items).collect()] == [(1, 1, 1)]


def test_bounds_leave_documents_out_and_lose_none():
    r = np.random.default_rng(4)
    n, width = 3000, 200
    vectors = [np.unique(np.minimum(width - 1, r.geometric(0.03, 12))) for _ in range(n)]
    vectors[500:900] = [vectors[5]] * 400                               # a path longer than any node needs
    starts = np.concatenate([[0], np.cumsum([len(v) for v in vectors])])
    flat = width - 1 - np.concatenate(vectors)
    by = np.lexsort((flat, np.repeat(np.arange(n), np.diff(starts))))
    tfs = r.integers(1, 4, len(flat))
    m = r.integers(75, 300, n)
    tree = ranked.Tree(starts, flat[by].astype(">i4"), tfs, m)
    looked = 0
    for _ in range(30):
        weights = np.zeros(width, np.int64)
        weights[r.choice(width, 8)] = r.integers(100, 9000, 8)
        part = weights[flat[by]] * ranked.share(tfs, np.repeat(m, np.diff(starts)))
        scores = np.add.reduceat(part, starts[:-1])
        want = sorted((-s, i) for i, s in enumerate(scores.tolist()) if s > 0)[:20]
        got, seen = tree.search(weights, np.arange(n), [], 20)
        assert got == want
        looked += seen
    assert looked < 30 * n * 0.6
