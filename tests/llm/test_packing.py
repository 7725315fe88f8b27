"""Packing: ids against the library, sweeps and sequences against plain versions."""

import bisect
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from labelforge.llm import packing
from labelforge.llm.common import stage
from labelforge.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", " ", None, "a\x0bb\x0cc\x1cd\x85e\xa0f　g", "don't I'LL x's they've", "é café café. e ́x",
         "ÀÉ! ÀÉ!! İstanbul ŉ ſ ß ẞ Σς ΑΣ. ª º µ × ÷ ²³¹½", "<|endoftext|> a<|startoftext|>b", "日本語テキスト。 你好,世界",
         "\t\n a  b \r\n", "x" * 5000, "word.. word.) (word a1 1a 12 one,two", "​ ﻿z ﬁ ﬂ Ａ", "same words " * 900]


def plain_ids():
    whole = Tokenizer.from_file(PATH)
    return [whole.encode(t or "", add_special_tokens=False).ids + [0] for t in TEXTS]


def test_ids_equal_the_library():
    codec = packing.WordCodec(PATH)
    for texts in ([t or "" for t in TEXTS], ["", ""], ["only"]):
        got = []
        for row, count, ids in codec.encode(pa.array(texts, pa.string())):
            assert row == len(got)
            got += np.split(ids, np.cumsum(count)[:-1])
        whole = Tokenizer.from_file(PATH)
        assert [x.tolist() for x in got] == [whole.encode(t, add_special_tokens=False).ids + [0] for t in texts]


def test_pieces_and_sequences_hold_every_token(spark, monkeypatch):
    monkeypatch.setattr(packing, "SLICE", 2000)
    monkeypatch.setattr(packing, "WORDS", 50)
    rows = [(i, t, 1, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], 2, "y"), (None, "no id", 3, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key int, length string").repartition(3)
    got = stage(packing.pack(docs, PATH, size=64), "packed")
    ids = plain_ids()
    whole = Tokenizer.from_file(PATH)
    want = sorted((i if i is not None else -1, p // 64, p, own[p:p + 64])
                  for (i, t, *_), own in zip(rows, [*ids, ids[3], whole.encode("no id").ids + [0]]) for p in range(0, len(own), 64))
    have = got.collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["piece"], r["start"], r["ids"]) for r in have) == want
    assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and r["length"] == len(r["ids"]) for r in have)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"]
    filled = {r["sequence_id"]: r["ids"] for r in packing.sequences(got).collect()}
    for r in have:
        assert filled[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == r["ids"]
    assert sum(map(len, filled.values())) == sum(r["length"] for r in have) and max(map(len, filled.values())) <= 64


def test_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id string, text string")
    assert packing.pack(docs, PATH).collect() == []


def sequential(lengths, size):
    rooms, n = [], 0
    for x in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, x)
        room = rooms.pop(at) if at < len(rooms) else size
        n += at >= len(rooms) and room == size
        bisect.insort(rooms, room - x)
    return n


@pytest.mark.parametrize("shape", ["mixed", "one length", "small", "tiny", "full"])
def test_few_sequences_whatever_the_lengths(spark, monkeypatch, shape):
    """Spread over many range partitions; all at most one in fifty above the volume or
    what one best-fit after another needs."""
    monkeypatch.setattr(packing, "TASK_ROWS", 100)
    r = np.random.default_rng(3)
    size = 512
    lengths = {"mixed": np.minimum(size, 1 + r.exponential(150, 3000).astype(int)), "one length": np.full(900, 170),
               "small": r.integers(1, 40, 4000), "tiny": np.full(1500, 1), "full": np.full(50, size)}[shape].tolist()
    parts = stage(spark.createDataFrame(list(enumerate(lengths)), "key long, length long"), "parts")
    got = parts.join(packing.assign(parts, size), "key").groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("own")).collect()
    assert sum(len(x["own"]) for x in got) == len(lengths)
    for x in got:
        at = 0
        for own in x["own"]:
            assert own["offset"] == at
            at += own["length"]
        assert at <= size
    least = max(-(-sum(lengths) // size), min(sequential(lengths, size), len(lengths)))
    assert len(got) <= least + max(1, least // 50)


def test_partitions_together_do_one_sweep(spark, monkeypatch):
    """A round's pairs are those of one best-fit sweep over all pieces and gaps."""
    monkeypatch.setattr(packing, "TASK_ROWS", 40)
    r = np.random.default_rng(9)
    for gap, piece in (((20, 100), (20, 90)), ((90, 100), (20, 50)), ((20, 40), (60, 90)), ((50, 51), (50, 51))):
        gaps = [(1000 + i, int(x)) for i, x in enumerate(r.integers(*gap, 150))]
        todo = [(i, int(x)) for i, x in enumerate(r.integers(*piece, 200))]
        events = sorted([(-g, 0, b) for b, g in gaps] + [(-n, 1, k) for k, n in todo])
        stack, want = [], {}
        for size, is_piece, own in events:
            if not is_piece:
                stack.append(own)
            elif stack:
                want[own] = stack.pop()
        got, pairs, left, room = packing._round(
            stage(spark.createDataFrame(todo, "key long, length long"), "t"),
            stage(spark.createDataFrame(gaps, "bin long, gap long"), "g"), 350, 100)
        have = {x["key"]: x["bin"] for df in pairs for x in df.collect()}
        assert have == want and got == len(want)
        assert {x["key"] for x in left.collect()} == {k for k, _ in todo} - set(want)
        rooms, length = dict(gaps), dict(todo)
        for k, b in want.items():
            rooms[b] -= length[k]
        assert {x["bin"]: x["gap"] for x in room.collect()} == rooms


def test_the_query_over_a_whole_table(spark):
    d = "/root/testdata/sf0.001"
    got = QUERIES["op13_best_fit"](spark, d).toPandas()
    whole = Tokenizer.from_file(PATH)
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    want = set()
    for x in docs:
        ids = np.array(whole.encode(x["text"] or "", add_special_tokens=False).ids + [0], "<u4")
        want |= {(x["doc_id"], n, p, min(2048, len(ids) - p), zlib.crc32(ids[p:p + 2048].tobytes()))
                 for n, p in enumerate(range(0, len(ids), 2048))}
    assert set(zip(got.doc_id, got.piece, got.start, got.length, got.ids_crc32)) == want and len(got) == len(want)
    ends = got.assign(end=got.offset + got.length).sort_values(["sequence_id", "offset"])
    assert (ends.offset == ends.groupby("sequence_id").end.shift(fill_value=0)).all() and ends.end.max() <= 2048
    least = -(-int(got.length.sum()) // 2048)
    assert got.sequence_id.nunique() <= max(least, sequential(got.length.tolist(), 2048)) + 1
