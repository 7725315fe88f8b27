"""Near-dedup against brute force over all pairs."""

import random

import pytest

from labelforge.llm import neardup
from labelforge.llm.graph import components

SCHEMA = "doc_id long, text string, kept string, component_id string, node string"


def shingle_set(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, num, den):
    sets = {i: shingle_set(t, k) for i, t in rows}
    least = {i: i for i in sets}

    def root(x):
        while least[x] != x:
            x = least[x]
        return x
    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            a, b = sets[i], sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                x, y = root(i), root(j)
                least[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def corpus():
    r = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    rows, base = [], [r.choice(words) for _ in range(120)]
    for i in range(60):                                   # a family of near copies, by few to many edits
        w = list(base)
        for _ in range(r.randrange(0, 9)):
            w[r.randrange(len(w))] = r.choice(words)
        rows.append((len(rows), " ".join(w)))
    rows += [(len(rows) + k, " ".join(r.choice(words) for _ in range(80))) for k in range(40)]
    rows += [(len(rows) + k, "Same TEXT of every copy\tin this group") for k in range(30)]
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "one"), (204, "ONE"), (205, "two words"), (206, "two\nwords"),
             (207, "long " * 30_000), (208, "LONG " * 29_000), (209, "nbsp is no space here at all")]
    return rows


@pytest.mark.parametrize("k,num,den", [(3, 85, 100), (5, 80, 100)])
def test_components_equal_brute_force(spark, monkeypatch, k, num, den):
    monkeypatch.setattr(neardup, "BLOCK", 16)             # hot keys and clusters take the block pairs
    monkeypatch.setattr(neardup, "SPREAD_ROWS", 8)
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], SCHEMA).repartition(5)
    got = neardup.near_duplicates(df, k, num, den).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == brute(rows, k, num, den)
    assert len(got) == len(rows)


def test_null_and_repeated_ids_and_empty_tables(spark):
    t = "a b c d e f g h i j"
    df = spark.createDataFrame([(None, t), (1, t), (1, t), (2, t), (2, "other words stand in this text of mine")],
                               "doc_id long, text string")
    got = sorted(map(tuple, neardup.near_duplicates(df).collect()), key=str)
    assert got == sorted([(None, 6, None, True), (1, 6, 1, True), (1, 6, 1, True), (2, 6, 1, False), (2, 4, 2, True)], key=str)
    assert sorted((r["doc_id"] or 0) for r in neardup.keep_one(df).collect()) == [0, 1, 2]
    other = spark.createDataFrame([("2", "quite another text of eight words stands here", 1), ("2", "a third text that has its own six words", 2),
                                   ("1", t, 3), ("2", t, 4), (None, t, 5), ("2", None, 6), ("2", "", 7)], "doc_id string, text string, __n int")
    assert sorted(r["__n"] for r in neardup.keep_one(other.repartition(3)).collect()) == [1, 2, 3, 5, 6, 7]
    empty = df.limit(0)
    assert neardup.near_duplicates(empty).collect() == [] and neardup.keep_one(empty).collect() == []


def test_radius_covers_pairs_at_the_threshold():
    for threshold in (0.8, 0.85):
        radius, chunks = neardup.plan(threshold)
        assert radius < 2 * len(chunks) and sum(map(len, chunks)) == neardup.K


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (300, 200)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 200: 200, 300: 200}


def test_keep_one_copies_no_texts_and_moves_them_once_for_the_verdict(spark, monkeypatch):
    written, plain = [], neardup.stage
    monkeypatch.setattr(neardup, "stage", lambda df, name: written.append((name, df.columns)) or plain(df, name))
    rows = [(i, t, f"n{i}") for i, t in corpus()] + [(5, "more words than one under id five", "again"), (201, "", "b"), (201, "", "c"),
                                                     (None, "no id", "d"), (None, "no id", "e"), (203, "one", "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, note string").repartition(5)
    got = neardup.keep_one(df)
    assert not [w for w in written if "text" in w[1]]     # the whole rows were written before
    want = {i for i, (_, _, first) in brute(corpus(), 5, 80, 100).items() if first}
    notes = sorted(r["note"] for r in got.collect())
    one = {"n203", "f"}                                   # equal in id and text: either of them
    assert len(one & set(notes)) == 1
    assert sorted(set(notes) - one) == sorted({f"n{i}" for i in want - {203}} | {"again", "b", "c", "d", "e"})
