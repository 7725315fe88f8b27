"""Language-model scoring with a gated recurrent network.

Documents whose crc32(doc_id) mod 7 is not 2 train.  Tokens are words, ASCII
case folded, and one end per document.  Word counts over all training documents
give the add-one base score and the network's vocabulary: the most frequent words
(the end first) are its own outputs, as many as the square root of the number of
distinct words and at least ``VOCABULARY``, all other words one
class whose members have add-one shares of that class, an unseen word the share
of one.  So the model is a distribution over all words, seen or not.

The network (``gru``) starts as the unigram model of the counts and learns from
every training document, once: the documents are cut into ``ROUNDS`` parts by
hash; in a round every task runs truncated backpropagation over its documents
of that part from the same weights, and the weights are averaged by tokens in a
tree of tasks.  Scoring carries the state through the whole document.

Defined cases: null or empty text is one end token; a null id trains; repeated
rows score alike; an empty table gives an empty result; without training
documents every word is unseen; extra columns are ignored.

Scale: words are counted per batch, then by one shuffle.  Words of at least an
even share of counts (``HEAD`` words at most, taken from a histogram of counts)
are looked up in the tasks, the end and the vocabulary always (ranked below
the whole bins of the histogram if those hold too few words); the rest, whose
counts are bounded by that share, are joined, once per document and word.  A long word goes by its digest.  The
driver holds the head, and weights of 260 bytes per word of the vocabulary, which is no
larger than the head.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, pieces, stage
from .gru import CLASSES, Model

VOCABULARY = 2048    # least number of network outputs besides "other"
HEAD = 65_536       # words looked up in tasks, at most
ROUNDS = 2           # averaging rounds; every training document is in one
WORD_BYTES = 64      # longer words go by their digest
FAN_IN = 8           # weight vectors that one task, and at last the driver, adds up
END = b""


def key_of(word: bytes) -> bytes:
    return word if len(word) <= WORD_BYTES else b"\x00" + hashlib.sha256(word).digest()


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _split(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(row of each word, place of each word's key among the keys, distinct keys) of a
    batch of texts, ASCII case folded and cut at ASCII white space."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(batch.column("text").fill_null("")))
    flat = pc.list_flatten(parts)
    rows = np.repeat(np.arange(batch.num_rows), np.asarray(pc.list_value_length(parts)))
    some = pc.not_equal(flat, "")                                # white space at either end leaves empty ones
    coded = flat.filter(some).dictionary_encode()
    keys = coded.dictionary.cast(pa.binary())
    if len(keys) and pc.max(pc.binary_length(keys)).as_py() > WORD_BYTES:
        keys = pa.array(map(key_of, keys.to_pylist()), pa.binary(), size=len(keys))
    return rows[np.asarray(some.to_numpy(zero_copy_only=False), bool)], np.asarray(coded.indices), keys


def _count(batches):
    for whole in batches:
        for batch in pieces(whole, "text"):
            _, at, keys = _split(batch)
            n = np.bincount(at, minlength=len(keys)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([keys, pa.array([END], pa.binary())]),
                                              pa.array(np.append(n, batch.num_rows))], ["word", "n"])


def grown(distinct: int, head: int = HEAD) -> int:
    """Network outputs for so many distinct words: their square root, within bounds."""
    return max(VOCABULARY, min(math.isqrt(distinct), head))


class Counts:
    """Word counts of the training documents: a table, totals, and the head."""

    def __init__(self, docs: DataFrame, head: int = HEAD, vocabulary: int | None = None):
        counted = map_arrow(docs.filter(~held_out("doc_id")).select("text"), _count, "word binary, n long")
        self.table = stage(counted.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
        # counts by eighth powers of two: a few hundred rows whatever the corpus
        size = F.when(F.length("word") > 0, F.floor(F.log2("n") * 8))          # none for the end
        rows = self.table.groupBy(size.alias("b")).agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("s")).collect()
        bins = sorted(((r["b"], r["k"], r["s"]) for r in rows if r["b"] is not None), reverse=True)
        ends = sum(r["s"] for r in rows if r["b"] is None)
        self.total, self.distinct = ends + sum(b[2] for b in bins), (ends > 0) + sum(b[1] for b in bins)
        taken, self.least, over = 0, None, None
        for b, k, _ in bins:
            if taken + k > head:
                over = b
                break
            taken, self.least = taken + k, b
        in_head = F.lit(False) if self.least is None else F.coalesce(size >= self.least, F.lit(False))
        got = [(r["n"], bytes(r["word"])) for r in self.table.filter(in_head).collect()]
        own = max(0, (grown(self.distinct, head) if vocabulary is None else vocabulary) - 1)
        if over is not None and taken < own:                       # the vocabulary goes on there
            more = self.table.filter(size <= over).orderBy(F.desc("n"), "word").limit(own - taken)
            got += [(r["n"], bytes(r["word"])) for r in more.collect()]
        self.tail = self.table.filter(~in_head)                    # holds these, too: nobody asks for them
        got = sorted(got, key=lambda x: (-x[0], x[1]))
        self.head = {w: n for n, w in [(ends, END)] * (ends > 0) + got}
        self.vocabulary = [END, *(w for _, w in got[:own])] if ends else []
        self.counts = np.array([self.head[w] for w in self.vocabulary], np.float64)
        self.rest = int(self.total - self.counts.sum())            # tokens of the class "other"
        self.rest_words = self.distinct - len(self.vocabulary)

    def base(self, n: int) -> float:
        return math.log10((n + 1) / (self.total + self.distinct + 1))

    def inside_other(self, n: int) -> float:
        return math.log10((n + 1) / (self.rest + self.rest_words + 1))


_ENCODED = ("row long, doc_id {kind}, held_out boolean, n_tokens long, known long, base double, other double, "
            "ids binary, tail array<struct<word:binary,n:bigint>>")


def id_type(vocabulary: int) -> type:
    """The type that ids 0 .. ``vocabulary`` are written in."""
    return np.uint16 if vocabulary < 1 << 16 else np.uint32


def _binary(data: bytes, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _encode(counts: Counts):
    other, head = len(counts.vocabulary), counts.head
    of_id = {w: k for k, w in enumerate(counts.vocabulary)}
    words = [w for w in head if w != END]
    # of every head word, and at last of any other one: id, base score, score inside "other", whether it is known
    ids = np.array([*(of_id.get(w, other) for w in words), other], id_type(other))
    base = np.array([*(counts.base(head[w]) for w in words), 0.0])
    inside = np.array([*(0.0 if w in of_id else counts.inside_other(head[w]) for w in words), 0.0])
    end_known = END in head
    end_id = of_id.get(END, other)
    end_base = counts.base(head.get(END, 0))
    end_inside = 0.0 if END in of_id else counts.inside_other(head.get(END, 0))
    width = ids.itemsize

    def run(batches):
        known_words = pa.array(words, pa.binary())
        for whole in batches:
            for batch in pieces(whole, "text"):
                n = batch.num_rows
                row, at, keys = _split(batch)
                place = np.asarray(pc.index_in(keys, value_set=known_words).fill_null(len(words))).astype(np.int64)
                of = place[at]
                size = np.bincount(row, minlength=n)
                seq = np.full(len(row) + n, end_id, ids.dtype)             # an end behind every row
                seq[np.arange(len(row)) + row] = ids[of]
                ends = np.cumsum(size + 1)
                # words outside the head: one entry for each row and word
                rare = of == len(words)
                pair, times = np.unique(row[rare] * max(1, len(keys)) + at[rare], return_counts=True)
                begin = np.searchsorted(pair, np.arange(n + 1) * max(1, len(keys)))
                tail = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.StructArray.from_arrays(
                    [keys.take(pa.array(pair % max(1, len(keys)))), pa.array(times.astype(np.int64))], ["word", "n"]))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("row", "doc_id", "held_out")), pa.array(size + 1, pa.int64()),
                     pa.array(np.bincount(row, ~rare, n).astype(np.int64) + end_known),
                     pa.array(np.bincount(row, base[of], n) + end_base), pa.array(np.bincount(row, inside[of], n) + end_inside),
                     _binary(seq.tobytes(), width * ends), tail],
                    ["row", "doc_id", "held_out", "n_tokens", "known", "base", "other", "ids", "tail"])
    return run


def _sequences(column, vocabulary: int) -> list[np.ndarray]:
    return [np.frombuffer(x, id_type(vocabulary)).astype(np.int32) for x in column.to_pylist()]


def _train(model: Model):
    def run(batches):
        start = model.vector()
        own = Model(np.ones(0), 1.0)
        own.__dict__.update(model.__dict__, p=dict(model.p))
        own.load(start.copy())
        adam, tokens, held, size = None, 0, [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                seqs = _sequences(batch.column("ids").slice(at, 1024), model.other)
                held += seqs
                size += sum(map(len, seqs))
                if size >= 1 << 20:
                    adam = own.train(np.concatenate(held), adam=adam)
                    tokens, held, size = tokens + size, [], 0
        if held:
            own.train(np.concatenate(held), adam=adam)
            tokens += size
        if tokens:
            yield _weighed(own.vector().astype(np.float64) * tokens, tokens)
    return run


def _weighed(total: np.ndarray, tokens: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([tokens], pa.int64())],
                                      ["weights", "tokens"])


def _add(batches):
    total, tokens = None, 0
    for batch in batches:
        for w, n in zip(batch.column("weights").to_pylist(), batch.column("tokens").to_pylist()):
            w = np.frombuffer(w, np.float64)
            total = w.copy() if total is None else total + w
            tokens += n
    if tokens:
        yield _weighed(total, tokens)


def fit(encoded: DataFrame, counts: Counts, rounds: int = ROUNDS) -> Model:
    """A model that has learnt from every training row of ``encoded``."""
    model = Model(counts.counts, float(counts.rest), classes=max(CLASSES, math.isqrt(len(counts.counts) // 2)))
    if not counts.vocabulary:
        return model
    schema = "weights binary, tokens long"
    for part in range(rounds):
        own = encoded.filter(~F.col("held_out") & (F.pmod(F.xxhash64("row"), F.lit(rounds)) == part)).select("ids")
        grown = stage(map_arrow(own, _train(model), schema), "weights")
        n = grown.count()
        while n > FAN_IN:                                      # averaged by a tree of tasks
            n = -(-n // FAN_IN)
            grown = stage(map_arrow(grown.repartition(n), _add, schema), "weights")
        got = grown.collect()
        if got:
            total = sum(np.frombuffer(r["weights"], np.float64) for r in got)
            model.load(total / sum(r["tokens"] for r in got))
    return model


def _score(model: Model):
    log10 = math.log(10)

    def run(batches):
        for whole in batches:
            sizes = np.cumsum(whole.column("n_tokens").to_numpy())
            start = 0
            while start < whole.num_rows:                      # about four million tokens together
                end = max(start + 1, int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + (1 << 22), "right")))
                batch = whole.slice(start, end - start)
                got = model.score(_sequences(batch.column("ids"), model.other)) / log10
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("row", "doc_id", "held_out", "n_tokens", "known", "base")),
                     pa.array(got + batch.column("other").to_numpy())],
                    ["row", "doc_id", "held_out", "n_tokens", "known", "base", "score"])
                start = end
    return run


def score(docs: DataFrame, vocabulary: int | None = None, rounds: int = ROUNDS, head: int = HEAD) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per
    document of (doc_id, text); scores are log10 probabilities."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    counts = Counts(docs, head, vocabulary)
    kind = dict(docs.dtypes)["doc_id"]
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", held_out("doc_id").alias("held_out"), "text")
    encoded = stage(map_arrow(numbered, _encode(counts), _ENCODED.format(kind=kind)), "encoded")
    model = fit(encoded, counts, rounds)
    tail = encoded.select("row", F.explode("tail").alias("t")).select("row", F.col("t.word").alias("word"), F.col("t.n").alias("n"))
    c = F.coalesce(F.col("c"), F.lit(0))
    sums = tail.join(counts.tail.select("word", F.col("n").alias("c")), "word", "left").groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("tail_known"),
        F.sum(F.col("n") * (F.log10(c + 1) - F.lit(math.log10(counts.total + counts.distinct + 1)))).alias("tail_base"),
        F.sum(F.col("n") * (F.log10(c + 1) - F.lit(math.log10(counts.rest + counts.rest_words + 1)))).alias("tail_score"))
    scored = map_arrow(encoded.select("row", "doc_id", "held_out", "n_tokens", "known", "base", "other", "ids"), _score(model),
                       f"row long, doc_id {kind}, held_out boolean, n_tokens long, known long, base double, score double")
    zero = F.lit(0.0)
    return scored.join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(counts.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("tail_base", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("tail_score", zero)).alias("score"))
