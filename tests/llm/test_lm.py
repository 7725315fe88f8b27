"""The language model: gradients, normalisation, carried state, base scores,
and a gain on held-out text."""

import math
import random
import zlib
from collections import Counter

import numpy as np

from labelforge.llm import lm
from labelforge.llm.gru import WINDOW, Model

SCHEMA = "doc_id long, text string, score string, row string, ids string"


def small(seed=1):
    m = Model(np.array([5.0, 9, 4, 3, 2, 1, 1]), 6.0, hidden=5, classes=3, seed=seed)
    r = np.random.default_rng(seed)
    m.p = {k: (v + 0.3 * r.normal(size=v.shape)).astype(np.float64) for k, v in m.p.items()}
    return m


def test_probabilities_sum_to_one():
    m = small()
    states = np.random.default_rng(2).normal(size=(4, 5))
    for s in states:
        ids = np.arange(m.other + 1)
        got = m.log_probs(np.repeat(s[None], len(ids), 0), ids)
        assert abs(np.exp(got).sum() - 1) < 1e-9


def test_gradients_equal_differences():
    m = small()
    r = np.random.default_rng(3)
    targets = r.integers(0, m.other + 1, (3, 9))
    targets[0, 4] = 0
    inputs = np.concatenate([np.zeros((3, 1), int), targets[:, :-1]], 1)

    def loss():
        states, _ = m.steps(inputs, np.zeros((3, 5)))
        return -m.log_probs(states.reshape(-1, 5).astype(np.float64), targets.ravel()).sum()
    before = {k: v.copy() for k, v in m.p.items()}
    adam = {"t": 0, "m": {}, "v": {}}
    m._learn(inputs, targets, np.ones((3, 9), bool), np.zeros((3, 5)), 0.0, adam)
    for k, v in adam["m"].items():                     # first moment after one step: a tenth of the mean gradient
        m.p[k] = before[k].copy()
        g = v * 10 * targets.size
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        h = 1e-3
        m.p[k][at] += h
        up = loss()
        m.p[k][at] -= 2 * h
        assert abs((up - loss()) / (2 * h) - g[at]) < 2e-2 * max(1, abs(g[at])), k
        m.p[k] = before[k].copy()


def test_state_is_carried_across_windows_and_rows_do_not_meet():
    m = small()
    r = np.random.default_rng(4)
    docs = [np.append(r.integers(1, m.other + 1, n), 0).astype(np.int32) for n in (0, 1, 3 * WINDOW + 5, 7, WINDOW, WINDOW - 1, 200)]
    whole = m.score(docs)
    for d, got in zip(docs, whole):
        state, want = np.zeros((1, 5)), 0.0
        for t, token in enumerate(d):
            states, state = m.steps(np.array([[0 if t == 0 else d[t - 1]]]), state)
            want += m.log_probs(states[:, 0].astype(np.float64), np.array([token]))[0]
        assert abs(want - got) < 1e-3 * max(1, len(d) / 10)


def corpus(n=240):
    r = random.Random(5)
    words = ["the", "cat", "sat", "on", "a", "mat", "dog", "ran"]
    rows = []
    for k in range(n):                                  # every word is followed by its neighbour in the list
        at, out = r.randrange(8), []
        for _ in range(r.randrange(5, 60)):
            out.append(words[at % 8].upper() if r.random() < 0.1 else words[at % 8])
            at += 1 if r.random() < 0.9 else r.randrange(8)
        rows.append((k, " ".join(out) + (f" rare{k % 50}" if k % 3 == 0 else "")))
    return rows + [(1000, None), (1001, ""), (1002, "the " * 30_000), (1003, "unseen words only here"), (1004, "x" * 500)]


def test_base_scores_edge_rows_and_held_out_gain(spark, monkeypatch):
    monkeypatch.setattr(lm, "FAN_IN", 2)                # weights are averaged in a tree
    rows = corpus()
    df = spark.createDataFrame([(*r, "s", "r", "i") for r in rows + [(7, rows[7][1])]], SCHEMA).repartition(5)
    got = lm.score(df, vocabulary=8, head=12).collect()
    assert len(got) == len(rows) + 1
    tokens = {i: (t or "").encode().lower().split() + [b""] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    c = Counter(w for i, own in tokens.items() if not held[i] for w in own)
    if not held[7]:
        c.update(tokens[7])
    total, distinct = sum(c.values()), len(c)
    for r in got:
        own = tokens[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[r["doc_id"]], len(own), total)
        assert r["n_known"] == sum(c[w] > 0 for w in own)
        want = sum(math.log10((c[w] + 1) / (total + distinct + 1)) for w in own)
        assert abs(r["base_score"] - want) < 1e-6 * max(1, abs(want))
    out = [r for r in got if r["held_out"] and r["doc_id"] < 1000]
    assert len(out) > 10 and sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    assert len({r["score"] for r in got if r["doc_id"] == 7}) == 1


def test_empty_table_and_no_training_documents(spark):
    df = spark.createDataFrame([(i, "a b") for i in range(40) if zlib.crc32(str(i).encode()) % 7 == 2], "doc_id long, text string")
    assert lm.score(df.limit(0)).collect() == []
    for r in lm.score(df).collect():
        assert (r["held_out"], r["n_known"], r["train_tokens"], r["base_score"]) == (True, 0, 0, 0.0)
        assert r["score"] <= 0


def test_the_end_and_the_vocabulary_are_known_whatever_the_counts(spark):
    """One long document: 70,000 words of one count, more than the head holds."""
    words = [f"w{k}" for k in range(70_000)]
    one = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 != 2)
    df = spark.createDataFrame([(one, " ".join(words))], "doc_id long, text string")
    counts = lm.Counts(df)
    assert counts.head[lm.END] == 1 and (counts.total, counts.distinct) == (70_001, 70_001)
    assert counts.vocabulary == [lm.END] + sorted(w.encode() for w in words)[:lm.VOCABULARY - 1]
    got = lm.score(df).first()
    want = 70_001 * math.log10(2 / (70_001 + 70_001 + 1))
    assert (got["n_tokens"], got["n_known"]) == (70_001, 70_001)
    assert abs(got["base_score"] - want) < 1e-6 * abs(want) and got["score"] != got["base_score"]


def test_more_frequent_words_than_the_head_holds(spark):
    """Few long texts: every word is more frequent than the end."""
    rows = [(k, " ".join(f"v{(k * j) % 40}" for j in range(4000))) for k in range(1, 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    train = [t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    c = Counter(w for t in train for w in t.encode().split() + [b""])
    counts = lm.Counts(df, head=10, vocabulary=21)
    assert counts.vocabulary == [b""] + sorted((w for w in c if w), key=lambda w: (-c[w], w))[:20]
    total, distinct = sum(c.values()), len(c)
    for r in lm.score(df, head=10, vocabulary=21).collect():
        own = dict(rows)[r["doc_id"]].encode().split() + [b""]
        want = sum(math.log10((c[w] + 1) / (total + distinct + 1)) for w in own)
        assert r["n_known"] == sum(c[w] > 0 for w in own) and abs(r["base_score"] - want) < 1e-6 * abs(want)


def test_steps_equal_the_plain_recurrence_and_lie_in_one_block_each():
    m, r = small(7), np.random.default_rng(8)
    inputs = r.integers(0, m.other + 1, (4, 11))
    states, last = m.steps(inputs, np.zeros((4, 5)))
    p, sigmoid = m.p, lambda z: 1 / (1 + np.exp(-z))
    for k in range(4):
        h = np.zeros(5)
        for t in range(11):
            h = h * (inputs[k, t] != 0)
            x, u = p["x"][inputs[k, t]], h @ p["u"]
            reset, update = sigmoid(x[:5] + u[:5]), sigmoid(x[5:10] + u[5:10])
            new = np.tanh(x[10:] + reset * (u[10:] + p["c"]))
            h = new + update * (h - new)
            assert np.allclose(states[k, t], h, atol=1e-12)
        assert np.allclose(last[k], h, atol=1e-12)
    assert all(states[:, t].flags.c_contiguous for t in range(11))     # rows came first before
