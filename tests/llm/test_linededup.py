"""Unit dedup against a plain version over all units."""

import random
import re

import pytest

from labelforge.llm import linededup

SCHEMA = "doc_id long, text string, n_chars long, spans string, row string"


def plain(rows, pattern, min_size):
    """Removed (start, end, keeper) per row position; rows in rank order."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    seen, out = {}, {}
    for k in order:
        out[k], run = [], []
        for m in re.finditer(pattern, rows[k][1] or ""):
            words = re.findall(r"[^\x20\x09-\x0D]+", re.sub(r"[.!?。！？ \t\n\x0b\x0c\r]+\Z", "", m.group()))
            if not words:
                continue
            norm = " ".join(re.sub(r"[A-Z]", lambda c: c.group().lower(), w) for w in words)
            if norm in seen:
                run.append((m.start(), m.end(), rows[seen[norm]][0], sum(len(w) // 5 if len(w) > 20 else 1 for w in words)))
                continue
            seen[norm] = k
            out[k] += [u[:3] for u in run] if sum(u[3] for u in run) >= min_size else []
            run = []
        out[k] += [u[:3] for u in run] if sum(u[3] for u in run) >= min_size else []
    return out


def corpus():
    r = random.Random(8)
    stock = [" ".join(r.choice("abcdefgh") * r.randrange(1, 4) for _ in range(r.randrange(3, 14))) for _ in range(40)]
    ends = [". ", "! ", "\n", "。", "? ", ".\n", "\n\n"]
    rows = [(k, "".join(r.choice(stock).upper() + r.choice(ends) if r.random() < 0.2 else r.choice(stock) + r.choice(ends)
                        for _ in range(r.randrange(0, 9)))) for k in range(120)]
    passage = "this passage of many words was pasted into the middle of a line. It has two sentences of its own in it."
    rows += [(200, "before it, " + passage + " after it"), (201, "other words, " + passage + " and an end"), (202, None), (203, ""),
             (206, "Buy it now. Call us today. No cost at all. Act fast please. Do not wait."),
             (207, "other text. buy it now. call us today. no cost at all. Act fast please. Do not wait."), (208, "alone. Buy it now. x"),
             (209, "今天天气很好我们一起去公园散步吧然后回家吃饭看电视睡觉了好明天见"), (210, "今天天气很好我们一起去公园散步吧然后回家吃饭看电视睡觉了好明天见"),
             (211, "short-but-over-twenty-letters a b\n"), (212, "short-but-over-twenty-letters a b\n"),
             (204, "one two three four five six seven. " * 3000), (205, ".!?\n" * 1000)]
    return rows


@pytest.mark.parametrize("pattern", [linededup.SENTENCE, linededup.LINE, linededup.PARAGRAPH])
def test_removed_units_equal_the_plain_version(spark, pattern):
    rows = corpus()
    df = spark.createDataFrame([(i, t, None if t is None else len(t), "s", "r") for i, t in rows], SCHEMA).repartition(4)
    got = {r["doc_id"]: [tuple(u) for u in r["removed"] or []] for r in linededup.find(df, pattern).collect()}
    want = {rows[k][0]: v for k, v in plain(rows, pattern, linededup.MIN_SIZE).items()}
    assert got == want
    assert any(want[201]) == (pattern == linededup.SENTENCE) and want[210] and want[212]
    if pattern == linededup.SENTENCE:
        assert len(want[207]) == 5 and not want[208]
    text = dict(rows)
    for r in linededup.clean(df, pattern).collect():
        t = text[r["doc_id"]]
        for a, b, _ in reversed(want[r["doc_id"]]):
            t = t[:a] + t[b:]
        assert r["text"] == t and r["n_chars"] == (None if t is None else len(t))


def test_units_cover_the_whole_text():
    for _, text in corpus():
        for pattern in (linededup.SENTENCE, linededup.LINE, linededup.PARAGRAPH):
            assert "".join(m.group() for m in re.finditer(pattern, text or "")) == (text or "")


def test_null_and_repeated_rows_and_empty_tables(spark):
    t = "a line of six words is here\n"
    df = spark.createDataFrame([(1, t, 0, "", ""), (1, t, 0, "", ""), (None, t, 0, "", "")], SCHEMA).coalesce(1)
    got = sorted((r["doc_id"] or 0, r["n_units"], r["n_removed"], r["spans"], r["keepers"]) for r in linededup.report(df).collect())
    assert got == [(0, 1, 1, "0:28", "1"), (1, 1, 0, "", ""), (1, 1, 1, "0:28", "1")]
    assert linededup.report(df.limit(0)).collect() == [] and linededup.clean(df.limit(0)).collect() == []


def test_rows_that_repeat_an_id_keep_their_own_texts(spark):
    a, b = "one sentence has many words in it indeed. ", "quite another text of more than six words. "
    df = spark.createDataFrame([("x", a + b, 0, "", ""), ("x", b + "and a new end.", 0, "", ""), ("x", "a third text.", 0, "", ""),
                                (None, a, 0, "", ""), (None, "last.", 0, "", "")],
                               "doc_id string, text string, n_chars long, spans string, row string").coalesce(1)
    got = [r["text"] for r in linededup.clean(df).collect()]
    assert sorted(got) == sorted([a + b, " and a new end.", "a third text.", " ", "last."])
    assert linededup.clean(df).columns == df.columns
