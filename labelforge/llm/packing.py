"""Best-fit packing of token sequences in bulk-synchronous rounds.

``cut`` turns every document into token ids followed by one end id, cut into
pieces of at most ``size`` tokens.  ``assign`` packs pieces into sequences of
``size`` tokens, band by band of length, longest first.  A round of a band is
one best-fit step for all its pieces at once: pieces and gaps (the room left in
open sequences) are sorted together by size over range partitions, and a sweep
from large to small gives every piece the smallest gap not yet taken that holds
it.  Where several pieces want one gap, the one of higher rank (longer, then
smaller key) gets it and the next takes the next larger gap.  What a partition
cannot match within itself meets the leftovers of the partitions before it:
the counts of leftovers, one pair of numbers per partition, say which leftover
piece meets which leftover gap, and a join on (partition, place) brings them
together, so the partitions together do one exact sweep.  Gaps shrink by what
they took, and the round repeats while it places a share of the pieces.  What no
gap holds opens new sequences, k pieces of length at most ``size`` / k in each;
fewer than k remain of every k, and these few (at most about ``size`` times the
logarithm of ``size``, however many documents there are) are best-fitted on the
driver.  The gaps of new sequences take part in the next bands.

A gap that surely holds several pieces of the band takes that many in a round.

Defined cases: null or empty text is the end id alone; a piece of exactly
``size`` tokens is a sequence of its own; repeated rows and ids are separate
documents; an empty table gives no rows; other columns are ignored.

Scale: rounds move only (key, length) of the band's pieces and (sequence, gap)
of the gaps it fits into.  Their number follows from ``size`` and the shape of
the lengths, not from the number of documents.  Ties of one length, however
many, are ordered by key and spread over range partitions like other rows.
"""

from __future__ import annotations

import bisect
import functools
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bpe import byte_characters
from .common import map_arrow, pieces, stage

SIZE = 2048
SLICE = 32 << 20            # bytes of text encoded at a time
WORDS = 1_000_000           # occurrences whose ids are laid out at a time
TASK_ROWS = 16_384          # rows of a round per task, until the session's partitions are all used
END = 0
SHARE = 32                  # a band's rounds end when one places less than 1 / SHARE of its pieces

# Letters whose lower case, composition and class are the same in every Unicode version,
# and the signs that may follow them (all of ASCII but the apostrophe).
_WORD = r"^(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[!-&(-/:-@\[-`{-~]*)$"


@functools.cache
def _tokenizers(path: str):
    """(the whole tokenizer, its merges alone for byte-mapped words between spaces, which
    ids end a word) of a tokenizer file; read once per Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, models, pre_tokenizers
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    suffix = model["end_of_word_suffix"]
    words = Tokenizer(models.BPE(model["vocab"], merges, cache_capacity=0, end_of_word_suffix=suffix))
    words.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
    last = np.zeros(max(model["vocab"].values()) + 1, bool)
    last[[i for token, i in model["vocab"].items() if token.endswith(suffix)]] = True
    return Tokenizer.from_file(path), words, last


def _binary(data: bytes, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


class WordCodec:
    """Ids of a tokenizer file whose pre-tokens never cross white space and whose
    last sub-word of a pre-token is marked by a suffix.

    A text is cut at ASCII white space and each distinct chunk is encoded once.
    In a chunk of letters with signs behind them, letters and signs are pre-tokens of
    their own and the letters need the model's merges only; any other chunk takes
    the whole tokenizer.  Ids are kept as bytes, four for each."""

    def __init__(self, path: str):
        self.whole, self.words, self.last = _tokenizers(path)
        self.to_char = dict(enumerate(byte_characters())) | {32: " "}

    def _merged(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words of letters; an empty one has none."""
        step = 500
        some = words.filter(pc.not_equal(words, ""))
        ends = np.minimum(np.arange(0, len(some) + step, step), len(some)).astype(np.int32)
        groups = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), some), " ").to_pylist()
        mapped = [g if g.isascii() else g.encode().decode("latin-1").translate(self.to_char) for g in groups]
        coded = [np.array(x.ids, "<u4") for x in self.words.encode_batch_fast(mapped, add_special_tokens=False)]
        ids = np.concatenate(coded or [np.empty(0, "<u4")])
        own = np.zeros(len(words), np.int64)
        own[np.asarray(pc.not_equal(words, "").to_numpy(zero_copy_only=False), bool)] = np.diff(
            np.flatnonzero(self.last[ids]) + 1, prepend=0)
        return _binary(ids.tobytes(), 4 * np.cumsum(own))

    def _whole(self, chunks: pa.Array) -> pa.Array:
        coded = self.whole.encode_batch_fast(chunks.to_pylist(), add_special_tokens=False)
        return pa.array([np.array(x.ids, "<u4").tobytes() for x in coded], pa.binary())

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, number of ids of each row, ids of these rows), the end id
        included, for runs of consecutive rows of ``texts`` (no nulls)."""
        split = pc.ascii_split_whitespace(texts)
        until = np.cumsum(np.asarray(pc.list_value_length(split)).astype(np.int64) + 1)      # an end behind each row
        coded = pc.list_flatten(split).dictionary_encode()
        chunk = coded.dictionary
        parts = pc.extract_regex(chunk, _WORD)
        easy = pc.is_valid(parts)
        word = pc.if_else(easy, pc.utf8_lower(pc.struct_field(parts, "word")), "").dictionary_encode()
        rest = pc.if_else(easy, pc.struct_field(parts, "tail"), chunk).dictionary_encode()
        pool = pc.binary_join_element_wise(
            self._merged(word.dictionary).take(word.indices), self._whole(rest.dictionary).take(rest.indices), b"")
        pool = pa.concat_arrays([pool, pa.array([np.array([END], "<u4").tobytes()], pa.binary())])
        seen = np.full(int(until[-1]), len(pool) - 1, np.int32)
        inside = np.ones(len(seen), bool)
        inside[until - 1] = False
        seen[inside] = np.asarray(coded.indices)
        row = 0
        while row < len(until):
            begin = until[row - 1] if row else 0
            stop = max(row + 1, int(np.searchsorted(until, begin + WORDS, side="right")))
            ids = pool.take(pa.array(seen[begin:until[stop - 1]]))
            bounds = np.frombuffer(ids.buffers()[1], np.int32)[:len(ids) + 1][np.concatenate([[begin], until[row:stop]]) - begin]
            yield row, np.diff(bounds).astype(np.int64) >> 2, np.frombuffer(ids.buffers()[2], "<u4", int(bounds[-1]) >> 2)
            row = stop


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def cut(docs: DataFrame, path: str, size: int = SIZE, with_ids: bool = True) -> DataFrame:
    """(key, doc_id, piece, start, length, ids_crc32[, ids]) of every piece of every
    document; ``key`` tells pieces apart within this result once it is written."""
    def run(batches):
        codec = WordCodec(path)
        key = TaskContext.get().partitionId() << 33
        for whole in batches:
            for batch in pieces(whole, "text", SLICE):
                texts = batch.column("text").fill_null("")
                for row, count, ids in codec.encode(texts):
                    n = -(-count // size)                               # pieces of each row
                    at = np.repeat(np.cumsum(count) - count, n)
                    piece = _ranges(np.zeros(len(n), np.int64), n)
                    start = piece * size
                    length = np.minimum(np.repeat(count, n) - start, size)
                    begin = at + start
                    data = memoryview(ids).cast("B")
                    crc = [zlib.crc32(data[a:b]) for a, b in zip((4 * begin).tolist(), (4 * (begin + length)).tolist())]
                    of = pa.array(row + np.repeat(np.arange(len(n)), n))
                    columns = [pa.array(key + np.arange(len(piece))), batch.column("doc_id").take(of),
                               pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                    if with_ids:
                        offsets = np.concatenate([begin, [len(ids)]]).astype(np.int32)
                        columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32))))
                    key += len(piece)
                    yield pa.RecordBatch.from_arrays(columns, names)

    narrow = docs.select("doc_id", "text")
    kind = dict(narrow.dtypes)["doc_id"]
    schema = f"key long, doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    names = ["key", "doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    return map_arrow(narrow, run, schema + ", ids array<int>" * with_ids)


def bands(size: int) -> list[tuple[int, int]]:
    """(above, up to) lengths packed together, longest first; those above half of
    ``size`` are not among them."""
    edges = sorted({size // 2, size // 3, size // 4, size // 6, size // 16, 0}, reverse=True)
    return list(zip(edges[1:], edges))


def _rows(pid: int, kind: int, *columns: list) -> pa.RecordBatch:
    n = len(columns[0])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, pid, np.int32)), pa.array(np.full(n, kind, np.int32)), *(pa.array(x, pa.int64()) for x in columns)],
        ["pid", "kind", "key", "bin", "size", "place", "n"])


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partition, sorted from large to small, gaps first.  Rows out, by kind: what
    matched (0: key, bin, length); pieces that found no gap (1: key, length, their
    rank as place); all gaps (2: bin, the room left, the first of their n places left,
    counted from the smallest gap on)."""
    pid = TaskContext.get().partitionId()
    stack: list[list[int]] = []                    # bin, room, places
    waiting = 0
    for batch in batches:
        keys, bins, lengths = [], [], []
        alone, long, closed, room = [], [], [], []
        for is_piece, own, size, gap, n in zip(*(batch.column(c).to_pylist() for c in ("is_piece", "id", "size", "gap", "n"))):
            if not is_piece:
                stack.append([own, gap, n])
            elif stack:
                top = stack[-1]
                keys.append(own)
                bins.append(top[0])
                lengths.append(size)
                top[1] -= size
                top[2] -= 1
                if not top[2]:
                    stack.pop()
                    closed.append(top[0])
                    room.append(top[1])
            else:
                alone.append(own)
                long.append(size)
        none, zero = [None] * len(keys), [0] * len(keys)
        yield _rows(pid, 0, keys, bins, lengths, none, zero)
        yield _rows(pid, 1, alone, [None] * len(alone), long, list(range(waiting, waiting + len(alone))), [0] * len(alone))
        yield _rows(pid, 2, [None] * len(closed), closed, room, [None] * len(closed), [0] * len(closed))
        waiting += len(alone)
    place = 0
    while stack:
        part = stack[:-10_001:-1]
        del stack[-10_000:]
        n = [x[2] for x in part]
        first = (place + np.cumsum([0, *n[:-1]])).tolist()
        place += sum(n)
        yield _rows(pid, 2, [None] * len(part), [x[0] for x in part], [x[1] for x in part], first, n)


def meet(counts: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """(partition, first rank, number, partition of the gaps, first place) of leftovers
    that meet, from (partition, pieces left, places left) in sorted order: pieces
    take places of the nearest partition before them first."""
    out, stack = [], []                            # stack: partition, next place, places left
    for p, n, places in sorted(counts):
        done = 0
        while done < n and stack:
            top = stack[-1]
            take = min(n - done, top[2])
            out.append((p, done, take, top[0], top[1]))
            done += take
            top[1] += take
            top[2] -= take
            if not top[2]:
                stack.pop()
        if places:
            stack.append([p, 0, places])
    return out


def _dealt(df: DataFrame, rows: int, *order: Column) -> DataFrame:
    """``df`` in ranges of ``order``, about ``TASK_ROWS`` rows a task until the session's
    shuffle partitions are all used."""
    n = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))
    return df.repartitionByRange(max(1, n), *order).sortWithinPartitions(*order)


def _round(todo: DataFrame, gaps: DataFrame, rows: int, upto: int) -> tuple[int, list[DataFrame], DataFrame, DataFrame]:
    """One sweep: (number placed, (key, bin, length) of these, pieces and gaps left)."""
    spark = todo.sparkSession
    places = F.greatest(F.lit(1), F.floor(F.col("gap") / upto)).cast("long")
    events = todo.select(F.lit(True).alias("is_piece"), F.col("key").alias("id"), F.col("length").alias("size"),
                         F.lit(0).cast("long").alias("gap"), F.lit(1).cast("long").alias("n")).unionByName(
        gaps.select(F.lit(False).alias("is_piece"), F.col("bin").alias("id"),
                    F.floor(F.col("gap") / places).cast("long").alias("size"), "gap", places.alias("n")))
    dealt = _dealt(events, rows, F.col("size").desc(), F.col("is_piece"), F.col("id"))
    swept = stage(map_arrow(dealt, _sweep, "pid int, kind int, key long, bin long, size long, place long, n long"), "swept")
    counts = swept.groupBy("pid").agg(F.count_if(F.col("kind") == 0).alias("placed"), F.count_if(F.col("kind") == 1).alias("pieces"),
                                      F.sum("n").alias("places")).collect()
    met = meet([(r["pid"], r["pieces"], r["places"]) for r in counts])      # a few numbers per partition
    placed = sum(r["placed"] for r in counts)
    pairs = [swept.filter("kind = 0").select("key", "bin", F.col("size").alias("length"))] * bool(placed)
    left = swept.filter("kind = 1").select("key", F.col("size").alias("length"))
    room = swept.filter("kind = 2").select("bin", F.col("size").alias("gap"))
    if not met:
        return placed, pairs, left, room
    ways = spark.createDataFrame(met, "pid int, from_rank long, n_met long, gap_pid int, from_place long")
    taken = ways.groupBy("gap_pid").agg(F.max(F.col("from_place") + F.col("n_met")).alias("until"))
    asked = swept.filter("kind = 1").select("pid", "key", F.col("size").alias("length"), "place").join(ways, "pid").filter(
        (F.col("place") >= F.col("from_rank")) & (F.col("place") < F.col("from_rank") + F.col("n_met"))).select(
        "key", "length", "gap_pid", (F.col("from_place") + F.col("place") - F.col("from_rank")).alias("slot"))
    offered = swept.filter("kind = 2 AND n > 0").select(F.col("pid").alias("gap_pid"), "bin", "place", "n").join(
        taken, "gap_pid").filter(F.col("place") < F.col("until")).select(
        "gap_pid", "bin", F.explode(F.sequence("place", F.least(F.col("place") + F.col("n"), F.col("until")) - 1)).alias("slot"))
    across = stage(asked.join(offered, ["gap_pid", "slot"]).select("key", "bin", "length"), "across")
    used = across.groupBy("bin").agg(F.sum("length").alias("used"))
    return (placed + sum(m[2] for m in met), [*pairs, across], left.join(across.select("key"), "key", "left_anti"),
            room.join(used, "bin", "left").select("bin", (F.col("gap") - F.coalesce("used", F.lit(0))).alias("gap")))


def best_fit(lengths: list[int], size: int) -> list[int]:
    """The sequence of each piece, one after another, longest first."""
    rooms: list[tuple[int, int]] = []              # (room, sequence), sorted
    out, n = [0] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = bisect.bisect_left(rooms, (lengths[i], -1))
        room, own = rooms.pop(at) if at < len(rooms) else (size, n)
        n = max(n, own + 1)
        out[i] = own
        bisect.insort(rooms, (room - lengths[i], own))
    return out


def _ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partition and the rank of a row among its partition's rows of one k."""
    pid, seen = TaskContext.get().partitionId(), {}
    for batch in batches:
        rank = []
        for k in batch.column("k").to_pylist():
            rank.append(seen.get(k, 0))
            seen[k] = rank[-1] + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(rank), pid, np.int32)), pa.array(rank, pa.int64())],
                                         ["key", "length", "k", "pid", "rank"])


def _open(todo: DataFrame, rows: int, size: int, first: int) -> tuple[int, DataFrame]:
    """(number of new sequences, (key, bin, length) of all of ``todo``): k pieces of
    length at most ``size`` / k to a sequence, and what is fewer than k by best fit.
    New sequences are numbered downwards from ``first``."""
    spark = todo.sparkSession
    shaped = todo.select("key", "length", F.floor(F.lit(size) / F.col("length")).cast("long").alias("k"))
    ranked = stage(map_arrow(_dealt(shaped, rows, F.col("k"), F.col("length").desc(), F.col("key")), _ranks,
                             "key long, length long, k long, pid int, rank long"), "ranked")
    # one row per partition and one per k more
    counts = sorted(ranked.groupBy("k", "pid").agg(F.count(F.lit(1)).alias("n")).collect())
    total: dict[int, int] = {}
    before = []
    for k, pid, n in counts:
        before.append((k, pid, total.get(k, 0)))
        total[k] = total.get(k, 0) + n
    starts, new = {}, 0
    for k in total:
        starts[k] = new
        new += total[k] // k
    places = spark.createDataFrame([(k, pid, n, starts[k], total[k] // k) for k, pid, n in before],
                                   "k long, pid int, n_before long, start long, n_full long")
    own = ranked.join(places, ["k", "pid"]).withColumn("group", F.floor((F.col("rank") + F.col("n_before")) / F.col("k")))
    full = own.filter(F.col("group") < F.col("n_full")).select(
        "key", (F.lit(first) - F.col("start") - F.col("group")).cast("long").alias("bin"), "length")
    few = own.filter(F.col("group") >= F.col("n_full")).select("key", "length").collect()      # fewer than k of every k
    where = best_fit([r["length"] for r in few], size)
    rest = [(r["key"], first - new - w, r["length"]) for r, w in zip(few, where)]
    if rest:
        full = full.unionByName(spark.createDataFrame(rest, "key long, bin long, length long"))
    return new + max(where, default=-1) + 1, stage(full, "opened")


def assign(parts: DataFrame, size: int = SIZE) -> DataFrame:
    """(key, sequence_id, offset) of pieces (key, length), 0 <= key, 1 <= length <= ``size``.

    ``parts`` must give the same rows each time it is read (written, or a plain
    scan).  The pieces of a sequence lie side by side from offset 0."""
    small = parts.select("key", "length")
    alone = small.filter(F.col("length") > size // 2).select("key", F.col("key").alias("bin"), "length")
    placed = [alone]
    gaps = alone.filter(F.col("length") < size).select("bin", (F.lit(size) - F.col("length")).alias("gap"))
    ranges = bands(size)
    number = [((F.col("length") > above) & (F.col("length") <= upto)) for above, upto in ranges]
    n_gaps, *numbers = small.agg(F.count_if((F.col("length") > size // 2) & (F.col("length") < size)),
                                 *map(F.count_if, number)).first()
    first = -1
    for (above, upto), n, inside in zip(ranges, numbers, number):
        todo, fit = small.filter(inside), gaps.filter(F.col("gap") > above)
        got = n
        while n and n_gaps and got and got * SHARE >= n:
            got, pairs, todo, fit = _round(todo, fit.filter(F.col("gap") > above), n + n_gaps, upto)
            placed += pairs
            n -= got
        room = gaps.filter(F.col("gap") <= above).unionByName(fit.filter(F.col("gap") > 0))
        if n:
            new, pairs = _open(todo, n, size, first)
            placed.append(pairs)
            room = room.unionByName(pairs.groupBy("bin").agg((F.lit(size) - F.sum("length")).alias("gap")).filter("gap > 0"))
            first -= new
            n_gaps += new
        if above:
            gaps = stage(room, "gaps")
    every = placed[0]
    for pairs in placed[1:]:
        every = every.unionByName(pairs)
    before = Window.partitionBy("bin").orderBy(F.col("length").desc(), "key").rowsBetween(Window.unboundedPreceding, -1)
    return every.select("key", F.col("bin").alias("sequence_id"),
                        F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset"))


def pack(docs: DataFrame, path: str, size: int = SIZE, with_ids: bool = True) -> DataFrame:
    """``cut`` plus sequence_id and offset, without ``key``."""
    parts = stage(cut(docs, path, size, with_ids), "pieces")
    return parts.join(assign(parts, size), "key").drop("key")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of every sequence, in place; a sequence has
    at most ``size`` tokens."""
    own: Column = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(own, lambda x: x["ids"])).alias("ids"))
