"""Quality rules: base counts against a plain version, distances by hand."""

import math
import re
from collections import Counter

import numpy as np

from labelforge.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, kept string, js_chars string"


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += bool(WORD.search(line)) and line in seen
        seen.add(line)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))


GOOD = "The old house stood near the river and the garden of the town was quiet in the morning light. "
TEXTS = [None, "", "   \n\t", "one", "a a a a", "x\n\nx\n \nx y\nx y", GOOD * 5, "é日本 ß x |#| <b>", "a b c " * 40,
         " ".join(f"w{i}" for i in range(200)), "line one\nline two\nline one\n" * 30, "long " * 60_000 + "end"]


def test_base_counts_equal_the_plain_version(spark):
    df = spark.createDataFrame([(i, t, "en", "k", "j") for i, t in enumerate(TEXTS)] + [(None, GOOD, None, "k", "j")], SCHEMA)
    rows = {r["doc_id"]: r for r in quality.score(df).collect()}
    for i, t in enumerate(TEXTS):
        want = plain(t)
        r = rows[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, t
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    assert rows[None]["base_failed"] and len(rows) == len(TEXTS) + 1


def test_distance_by_hand():
    assert quality.js_distance(np.array([1.0, 0.0]), np.array([0.0, 1.0])) == 1.0
    assert quality.js_distance(np.array([2.0, 2.0]), np.array([5.0, 5.0])) == 0.0
    p, q = np.array([0.5, 0.5]), np.array([1.0, 0.0])
    want = math.sqrt((0.5 * math.log2(0.5 / 0.75) + 0.5 * math.log2(0.5 / 0.25) + math.log2(1 / 0.75)) / 2)
    assert abs(quality.js_distance(p, q) - want) < 1e-12


def test_junk_goes_and_clean_text_of_each_language_stays(spark):
    r = np.random.default_rng(3)
    stock = {"en": ["the", "of", "and", "to", "in"], "de": ["der", "die", "und", "von", "zu"]}
    rows = []
    for i in range(60):
        lang = ("en", "de")[i % 2]
        words = [str(r.choice(stock[lang])) if r.random() < 0.45 else "".join(r.choice(list("abcdefgh"), 6)) + "." * (k % 9 == 0)
                 for k in range(160)]
        rows.append((i, " ".join(words), lang, "k", "j"))
    shout = " ".join(f"BUY{k}!!" for k in range(120))
    pipes = " | ".join("menu" + "".join(r.choice(list("abcdefgh"), 6)) for _ in range(120))
    rows += [(900, shout, "en", "k", "j"), (901, pipes, "de", "k", "j")]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = quality.keep(df)
    assert kept.columns == df.columns
    assert {x["doc_id"] for x in kept.collect()} == set(range(60))


def test_short_documents_are_not_judged_by_distance_and_empty_tables_work(spark):
    df = spark.createDataFrame([(1, "A! " * 3, "en", "", "")], SCHEMA)
    r = quality.score(df).first()
    assert r["js_chars"] is None and r["kept"] is False
    assert quality.score(df.limit(0)).collect() == [] and quality.keep(df.limit(0)).collect() == []


def plain_verdicts(rows):
    """``kept`` and distances by the rule, with plain dictionaries over all rows."""
    def histograms(text):
        chars = Counter()
        for c in text:
            if c in " \t\n\x0b\x0c\r":
                chars["space"] += 1
            elif c.isascii():
                chars["lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit()
                      else "stop" if c in ".,;:'\"!?()-" else "symbol"] += 1
            else:
                b = c.encode()
                chars["latin" if len(b) == 2 and b[0] <= 0xC9 else f"script{len(b)}"] += 1
        words = Counter(WORD.findall("".join(c.lower() if c.isascii() else c for c in text)))
        return chars, words

    def distance(p, q, keys):
        p, q = ([x.get(k, 0) / sum(x.values()) for k in keys] for x in (p, q))
        half = [sum(a * math.log2(2 * a / (a + b)) for a, b in zip(x, y) if a) for x, y in ((p, q), (q, p))]
        return math.sqrt(max(0.0, sum(half) / 2))

    def merged(words, top):
        return {**{w: words.get(w, 0) for w in top}, None: sum(n for w, n in words.items() if w not in top)}
    failed = {}
    chars, words = {}, {}
    for i, text, lang in rows:
        base = plain(text)
        failed[i] = base[0] < 50 or 100 * base[4] > 50 * base[0]
        if not failed[i]:
            c, w = histograms(text)
            chars.setdefault(lang, Counter()).update(c)
            words.setdefault(lang, Counter()).update(w)
    out = {}
    for i, text, lang in rows:
        out[i] = (not failed[i], None, None)
        if lang in chars and plain(text)[0] >= quality.MIN_WORDS:
            c, w = histograms(text)
            ranked = sorted(words[lang].items(), key=lambda x: (-x[1], quality.word_key(x[0].encode())))
            top = [x for x, _ in ranked[:quality.COMMON]]
            js = distance(c, chars[lang], set(c) | set(chars[lang])), distance(merged(w, top), merged(words[lang], top), [*top, None])
            out[i] = (not failed[i] and js[0] <= quality.MAX_CHARS_JS and js[1] <= quality.MAX_WORDS_JS, *js)
    return out


def test_verdicts_equal_the_plain_version(spark):
    """Also where common words are longer than 32 bytes, as in text without blanks."""
    r = np.random.default_rng(5)
    long = ["長い単語" * 5, "x" * 40, "é" * 30]
    rows = []
    for i in range(80):
        lang = ("en", "ja", None)[i % 3]
        stock = ["the", "of", "and", "a"] if lang == "en" else long
        words = [str(r.choice(stock)) if r.random() < 0.2 + 0.01 * i else f"W{r.integers(10_000)}é." for _ in range(int(r.integers(40, 130)))]
        rows.append((i, " ".join(words), lang))
    rows += [(100, None, "en"), (101, "", None), (102, "%%% $$$ " + " ".join(f"#{k}#" for k in range(90)), "en"), (103, "a b", "xx")]
    df = spark.createDataFrame([(*x, "k", "j") for x in rows], SCHEMA).repartition(3)
    want = plain_verdicts(rows)
    kept = Counter()
    for x in quality.score(df).collect():
        k, chars, words = want[x["doc_id"]]
        assert x["kept"] == k and (chars is None) == (x["js_chars"] is None)
        assert chars is None or abs(x["js_chars"] - chars) < 1e-9 and abs(x["js_words"] - words) < 1e-9
        kept[k] += 1
    assert kept[True] > 10 and kept[False] > 10
    assert {x["doc_id"] for x in quality.keep(df).collect()} == {i for i, w in want.items() if w[0]}
