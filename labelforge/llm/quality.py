"""Quality rules by distribution divergence.

Every document gets two histograms: character classes, and the common words of
its language plus one bin for all other words.  The language references are
the same histograms summed over all documents of that language that pass the
base rules, so they follow the corpus.  A document is rejected when the
Jensen-Shannon distance (square root of the divergence in bits, 0..1) to its
reference passes a limit; documents under a minimum length are not judged by a
histogram (too few samples), only by the base rules.

Defined cases: null or empty text has no words and fails the base rules; a null
language is a language of its own; a language without any passing document has
no reference and its documents are not judged by distance; repeated rows are
judged alike; other columns are ignored by ``score`` and kept by ``keep``.

Scale: one pass sums the histograms (partial sums per batch, then a shuffle of
(language, word) counts, words of any length: long ones under a digest of 17
bytes).  The top words are ranked within hashed parts of a language and then
among the tops of its parts, so no task sees all words of a language.  The
references, at most ``COMMON`` words of 32 bytes per language, are joined by
language -- broadcast by Spark itself when their written size allows it.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import as_bytes, map_arrow, pieces, stage

COMMON = 64          # common words per language reference
WORD_BYTES = 32      # longer words are counted under a digest
SALTS = 64           # the words of a language are ranked in so many parts first
MIN_WORDS = 50       # base rule and guard of the histogram rules
MAX_CHARS_JS = 0.30  # Jensen-Shannon distance limit, character classes
MAX_WORDS_JS = 0.48  # the same, common words

CLASSES = ("lower", "upper", "digit", "space", "stop", "symbol", "latin", "script2", "script3", "script4")
SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, js_chars double, js_words double")
_REF = "__lf_reference"


def _class_of_byte() -> np.ndarray:
    lut = np.full(256, 5, np.uint8)
    for b in range(256):
        c = chr(b)
        if b >= 0xF0:
            lut[b] = 9
        elif b >= 0xE0:
            lut[b] = 8
        elif b >= 0xC0:
            lut[b] = 6 if b <= 0xC9 else 7
        elif b >= 0x80:
            lut[b] = 10                      # continuation byte: no character of its own
        elif "a" <= c <= "z":
            lut[b] = 0
        elif "A" <= c <= "Z":
            lut[b] = 1
        elif c.isdigit():
            lut[b] = 2
        elif c in " \t\n\x0b\x0c\r":
            lut[b] = 3
        elif c in ".,;:'\"!?()-":
            lut[b] = 4
    return lut


_LUT = _class_of_byte()
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def word_key(word: bytes) -> bytes:
    """What a word is counted under: itself, or a digest that no UTF-8 text equals."""
    return word if len(word) <= WORD_BYTES else b"\xff" + hashlib.blake2b(word, digest_size=16).digest()


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window occurring twice or more."""
    if len(words) < 4:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    pair = np.unique(a[:-1] * len(ids) + a[1:], return_inverse=True)[1]
    _, inverse, count = np.unique(pair[:-1] * len(ids) + a[2:], return_inverse=True, return_counts=True)
    twice = count[inverse] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k:len(words) - 2 + k] |= twice
    return int(covered.sum())


def features(text: bytes) -> tuple[tuple[int, ...], np.ndarray, Counter]:
    """Base counts, character-class counts and word counts of one whole text."""
    words = text.split()                     # ASCII white space only, as the word rule asks
    raw = np.frombuffer(text, np.uint8)
    classes = np.bincount(_LUT[raw], minlength=11)[:10]
    seen: set[bytes] = set()
    dup_lines = 0
    if b"\n" in text:
        for line in text.split(b"\n"):
            if line in seen:
                dup_lines += bool(line.strip())
            else:
                seen.add(line)
    # code points in words: all characters but white space
    base = (len(words), int(classes.sum() - classes[3]), int(_SYMBOL[raw].sum()), dup_lines, repeated_words(words))
    counts = Counter(text.lower().split())
    for word in [w for w in counts if len(w) > WORD_BYTES]:
        counts[word_key(word)] += counts.pop(word)
    return base, classes, counts


def base_failed(base: tuple[int, ...]) -> bool:
    return base[0] < MIN_WORDS or 100 * base[4] > 50 * base[0]


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two count vectors, 0 (equal) to 1."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = [np.where(x > 0, x * np.log2(x / m), 0.0).sum() for x in (p, q)]
    return float(np.sqrt(max(0.0, (kl[0] + kl[1]) / 2)))


def _histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in pieces(whole, "text"):
            words: dict = {}
            chars: dict = {}
            for lang, text in zip(batch.column("lang").to_pylist(), as_bytes(batch.column("text"))):
                base, classes, counts = features(text)
                if base_failed(base):
                    continue
                chars[lang] = chars.get(lang, 0) + classes
                words.setdefault(lang, Counter()).update(counts)
            rows = [(lang, None, k, int(n)) for lang, c in chars.items() for k, n in enumerate(c)]
            rows += [(lang, w, -1, n) for lang, c in words.items() for w, n in c.items()]     # class -1: words
            cols = list(zip(*rows)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.int32()),
                 pa.array(cols[3], pa.int64())], ["lang", "word", "class", "n"])


def references(docs: DataFrame, common: int = COMMON) -> DataFrame:
    """One row per language: (lang, reference JSON), written to the shared folder."""
    counts = (map_arrow(docs.select("lang", "text"), _histograms, "lang string, word binary, class int, n long")
              .groupBy("lang", "class", "word").agg(F.sum("n").alias("n")))
    counts = stage(counts, "language-counts")
    top = counts.filter("class = -1").withColumn("part", F.pmod(F.xxhash64("word"), F.lit(SALTS)))
    for group in (("lang", "part"), ("lang",)):
        top = (top.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("n"), "word")))
               .filter(F.col("rank") <= common))
    words = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", F.base64("word").alias("w"), "n")))
                                    .alias("words"))
    sums = counts.groupBy("lang").agg(
        F.sum(F.when(F.col("class") == -1, F.col("n"))).alias("total"),
        *[F.sum(F.when(F.col("class") == k, F.col("n"))).alias(f"c{k}") for k in range(len(CLASSES))])
    ref = sums.alias("s").join(words.alias("w"), F.col("s.lang").eqNullSafe(F.col("w.lang")), "left").select(
        F.col("s.lang").alias("lang"), F.to_json(F.struct(
            "total", "words", F.array(*[f"c{k}" for k in range(len(CLASSES))]).alias("chars"))).alias(_REF))
    return stage(ref, "language-references")


class _Reference:
    def __init__(self, text: str):
        import base64
        got = json.loads(text)
        self.chars = np.array(got["chars"], float)
        listed = got.get("words") or []
        self.words = [base64.b64decode(w["w"]) for w in listed]
        known = [float(w["n"]) for w in listed]
        self.counts = np.array([*known, max(0.0, got["total"] - sum(known))])

    def distances(self, classes: np.ndarray, counts: Counter) -> tuple[float, float]:
        known = [counts.get(w, 0) for w in self.words]
        own = np.array([*known, sum(counts.values()) - sum(known)], float)
        return js_distance(classes.astype(float), self.chars), js_distance(own, self.counts)


def _judge(batch: pa.RecordBatch, refs: dict, limits: tuple[int, float, float]) -> list[tuple]:
    rows = []
    for text, ref in zip(as_bytes(batch.column("text")), batch.column(_REF).to_pylist()):
        base, classes, counts = features(text)
        failed = base_failed(base)
        chars = words = None
        if ref is not None and base[0] >= max(1, limits[0]):
            if ref not in refs:
                if len(refs) > 1000:
                    refs.clear()
                refs[ref] = _Reference(ref)
            chars, words = refs[ref].distances(classes, counts)
        kept = not failed and (chars is None or (chars <= limits[1] and words <= limits[2]))
        rows.append((*base, failed, kept, chars, words))
    return rows


def _with_reference(docs: DataFrame, common: int) -> DataFrame:
    refs = references(docs, common).withColumnRenamed("lang", "__lf_lang")
    return docs.join(refs, docs["lang"].eqNullSafe(refs["__lf_lang"]), "left").drop("__lf_lang")


def score(docs: DataFrame, min_words: int = MIN_WORDS, max_chars_js: float = MAX_CHARS_JS,
          max_words_js: float = MAX_WORDS_JS, common: int = COMMON) -> DataFrame:
    """(doc_id, base counts, base_failed, kept, js_chars, js_words) per document
    of (doc_id, text, lang)."""
    limits = (min_words, max_chars_js, max_words_js)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
             "js_chars", "js_words"]
    types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2

    def run(batches):
        refs: dict = {}
        for whole in batches:
            for batch in pieces(whole, "text"):
                cols = list(zip(*_judge(batch, refs, limits)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, types))], ["doc_id", *names])

    narrow = docs.select("doc_id", "text", "lang")
    kind = dict(narrow.dtypes)["doc_id"]
    return map_arrow(_with_reference(narrow, common), run, f"doc_id {kind}, {SCHEMA}")


def keep(docs: DataFrame, min_words: int = MIN_WORDS, max_chars_js: float = MAX_CHARS_JS,
         max_words_js: float = MAX_WORDS_JS, common: int = COMMON) -> DataFrame:
    """The rows of ``docs`` (all columns) that the rules keep."""
    limits = (min_words, max_chars_js, max_words_js)

    def run(batches):
        refs: dict = {}
        for whole in batches:
            for batch in pieces(whole, "text"):
                kept = [r[6] for r in _judge(batch, refs, limits)]
                yield batch.drop_columns([_REF]).filter(pa.array(kept, pa.bool_()))

    return map_arrow(_with_reference(docs, common), run, docs.schema)
