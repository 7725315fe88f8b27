"""Personal data: base rules against the regular expressions, the tagger by
held-out accuracy, reconciliation and redaction."""

import hashlib
import random
import re

import numpy as np

from labelforge.llm import pii
from labelforge.llm.bilstm import Tagger, char_ids, spans_of, tags_of

SCHEMA = "doc_id long, text string, n_chars long, spans string, n_ip string"


def reference(text):
    out = [(m.start(), m.end(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), m.end(), 1))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        s = sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d)))
        if 14 <= len(d) <= 19 and s % 10 == 0:
            out.append((m.start(), m.end(), 2))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), m.end(), 3))
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_base_spans_equal_the_expressions():
    r = random.Random(1)
    pieces = ["a@b.c", "x.y+z@host.example.org", "@", ".", "-", " ", "+49 (151) 234-5678", "4111 1111 1111 1111", "10.0.0.1",
              "999.1.1.1", "1.2.3.4.5.6.7.8", "0" * 20, "é", "日", "ab", "%", "+1", "12-34-56-78-90-12-34-56"]
    for _ in range(3000):
        text = "".join(r.choice(pieces) for _ in range(r.randrange(0, 9)))
        assert pii.base_spans(text) == reference(text), text
    for text in ("1" * 200_000, "a" * 200_000 + "@", "@" * 50_000, "1." * 50_000, "+" * 50_000, "+1(" * 30_000):
        assert pii.base_spans(text) == reference(text[:0]) or pii.base_spans(text)        # ends in time


def labelled(n, seed):
    r = random.Random(seed)
    x, y = [], []
    for _ in range(n):
        kind = r.randrange(4)
        name = "".join(r.choice("abcdefghij") for _ in range(6))
        span = [f"{name}@mail{r.randrange(9)}.example.com", ".".join(str(r.randrange(256)) for _ in range(4)),
                "4" + "".join(str(r.randrange(10)) for _ in range(15)),
                f"+{r.randrange(1, 99)} ({r.randrange(100, 999)}) {r.randrange(100, 999)}-{r.randrange(1000, 9999)}"][kind]
        lead = " ".join("".join(r.choice("abcdehionrst") for _ in range(r.randrange(2, 8))) for _ in range(3)) + " "
        text = lead + span + " and some more words"
        x.append(char_ids(text, pii.WIDTH))
        y.append(tags_of([(len(lead), len(lead) + len(span), kind)], pii.WIDTH) if len(lead) + len(span) <= pii.WIDTH
                 else tags_of([], pii.WIDTH))
    return np.stack(x), np.stack(y)


def test_gradients_and_held_out_accuracy():
    x, y = labelled(6, 0)
    t = Tagger()
    g = t._gradients(x, y)

    def loss():
        e = t._emissions(x)[2]
        a = e[:, 0] + t.p["s"]
        for k in range(1, x.shape[1]):
            a = e[:, k] + np.log(np.exp(a[:, :, None] + t.p["A"]).sum(1))
        rows, at = np.arange(len(x))[:, None], np.arange(x.shape[1])[None]
        gold = e[rows, at, y].sum() + t.p["s"][y[:, 0]].sum() + t.p["A"][y[:, :-1], y[:, 1:]].sum()
        return np.log(np.exp(a).sum(1)).sum() - gold
    for name in t.p:
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        keep = t.p[name][at]
        t.p[name][at] = keep + 1e-5
        up = loss()
        t.p[name][at] = keep - 1e-5
        assert abs((up - loss()) / 2e-5 - g[name][at]) < 1e-3 * max(1, abs(g[name][at])), name
        t.p[name][at] = keep
    x, y = labelled(500, 1)
    hx, hy = labelled(200, 2)
    tags = Tagger().train(x, y, steps=200).single().decode(hx)
    assert (tags == hy).all(1).mean() > 0.8


def test_tags_round_trip():
    spans = [(0, 3, 1), (3, 5, 1), (7, 9, 0)]
    assert spans_of(tags_of(spans, 12)) == spans


def test_query_columns_edge_rows_and_redaction(spark):
    x = "mail bob@ex.org or 10.0.0.1, card 4111 1111 1111 1111, call +49 (151) 234-5678."
    far = "word " * 40_000 + x
    rows = [(1, x), (2, None), (3, ""), (4, "clean text without any"), (5, far), (6, x), (None, x), (1, "é日 " + x)]
    df = spark.createDataFrame([(i, t, None if t is None else len(t), "s", "n") for i, t in rows], SCHEMA)
    got = pii.find(df).collect()
    assert len(got) == len(rows)
    for r, (i, t) in zip(sorted(got, key=lambda r: (r["doc_id"] or 0, r["base_sha256"])),
                         sorted(rows, key=lambda r: (r[0] or 0, digest(r[1])))):
        base = reference(t or "")
        assert r["base_sha256"] == digest(t)
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(s[2] == k for s in base) for k in range(4)]
        assert {f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in base} <= set(r["spans"].split(","))
    clean = pii.redact(df)
    assert clean.columns == df.columns
    by = {(r["doc_id"], r["n_chars"]): r["text"] for r in clean.collect()}
    want = "mail [EMAIL] or [IP], card [CARD], call [PHONE]."
    assert by[(6, len(want))] == want and by[(2, None)] is None and by[(4, 22)] == "clean text without any"
    assert pii.find(df.limit(0)).collect() == [] and pii.redact(df.limit(0)).collect() == []


def digest(t):
    return hashlib.sha256(",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in reference(t or "")).encode()).hexdigest()


def test_windows_cover_all_text_near_triggers_and_long_spans_are_one():
    text = "x" * 500 + "1" * 300 + "y" * 500 + "@"
    covered = np.zeros(len(text), bool)
    for a, b in pii.windows(text):
        covered[a:b] = True
    assert covered[500 - pii.REACH:800 + pii.REACH].all() and covered[-1] and not covered[:400].any()

    class Digits:                                       # tags every digit as one card span
        def decode(self, x):
            d = (x >= 16) & (x <= 25)
            first = d & ~np.concatenate([np.zeros((len(x), 1), bool), d[:, :-1]], 1)
            return np.where(first, 5, np.where(d, 6, 0)).astype(np.int8)
    spans = pii.tagged_spans([text], Digits())[0]
    assert spans[0] == (500, 800, 2)                    # windows reconciled into one span


def test_windows_cover_addresses_without_digit_or_at_sign():
    local, host = "john.smith" * 9, " (dot) ".join(["department"] * 20)
    for address in ("john.smith (at) example (dot) org", "a[at]b[dot]c", "a (at) b.c", f"{local} (at) {host}", f"{local}@{host}"):
        text = "word " * 60 + address + " word" * 60
        covered = np.zeros(len(text), bool)
        for a, b in pii.windows(text):
            covered[a:b] = True
        assert covered[300 - pii.REACH:300 + len(address) + pii.REACH].all() and not covered[:200].any(), address
        assert pii.plausible(address, 0)
    assert list(pii.windows("look (at) this " * 3)) and not list(pii.windows("no address (dot) here"))
    assert len(list(pii.windows("a" * 200_000 + "(at)" * 50_000 + "-" * 200_000))) > 0      # ends in time


def test_address_without_digit_or_at_sign_is_redacted(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdehionrst") for _ in range(r.randrange(3, 9)))
    rows = [(i, f"{word()} {word()} please write to {word()}.{word()}@{word()}.org or ask {word()} for it {word()}") for i in range(400)]
    secret = "john.smith (at) example (dot) org"
    rows.append((1000, f"the parents of the class may please write to {secret} or ask the office for it"))
    df = spark.createDataFrame([(i, t, len(t), "s", "n") for i, t in rows], SCHEMA).repartition(2)
    got = {x["doc_id"]: x["text"] for x in pii.redact(df).filter("doc_id = 1000").collect()}
    assert got[1000] == rows[-1][1].replace(secret, "[EMAIL]")
