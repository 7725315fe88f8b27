"""BPE against the rank-based library, exact round trips, the serialised model."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from labelforge.llm import bpe
from labelforge.llm.queries import tokenizer

SCHEMA = "doc_id long, text string, ids string, n_tokens string"
PATH, PATTERN = tokenizer()


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


def texts():
    r = random.Random(6)
    alphabet = "ab \n\t\r  'sTé日本ñ12.!?　\x1c  'll"
    out = ["".join(r.choice(alphabet) for _ in range(r.randrange(0, 120))) for _ in range(800)]
    return out + ["", " ", "  ", "\n", "it's we'll", "<|endoftext|>", "x" * 30_000, "é" * 9_000, " " * 9_000, "ab " * 20_000,
                  "\U0001f600 emoji", "\x00\x01", "a  b   c\n\n d", "word" * 5_000]


def test_ids_equal_the_library_and_decode_to_the_text(spark, reference):
    rows = [(i, t, "i", "n") for i, t in enumerate(texts())] + [(-1, None, "i", "n"), (5, texts()[5], "i", "n")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = bpe.digests(df, PATH, PATTERN).collect()
    assert len(got) == len(rows)
    by = {i: t or "" for i, t, _, _ in rows}
    for r in got:
        ids = reference.encode_ordinary(by[r["doc_id"]])
        assert r["n_tokens"] == len(ids), by[r["doc_id"]][:50]
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(by[r["doc_id"]].encode()).hexdigest()


def test_encode_and_decode_tables(spark, reference):
    df = spark.createDataFrame([(1, "The house.\nIt's ünïcode", "x", "y"), (2, None, "x", "y"), (None, "a", "x", "y")], SCHEMA)
    enc = bpe.encode(df, PATH, PATTERN)
    assert enc.columns == ["doc_id", "n_tokens", "ids"]
    rows = {r["doc_id"]: list(r["ids"]) for r in enc.collect()}
    assert rows[1] == reference.encode_ordinary("The house.\nIt's ünïcode") and rows[2] == []
    back = {r["doc_id"]: bytes(r["text"]) for r in bpe.decode(enc, PATH, PATTERN).collect()}
    assert back == {1: "The house.\nIt's ünïcode".encode(), 2: b"", None: b"a"}
    for f in (bpe.digests, bpe.encode):
        assert f(df.limit(0), PATH, PATTERN).collect() == []


def test_memo_overflow_changes_nothing(reference, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 50)
    model, ranks = bpe._model(PATH)
    codec = bpe.Codec(model, ranks, PATTERN)
    for at in range(0, 800, 40):
        part = texts()[at:at + 40]
        for t, parts in zip(part, codec.encode_all(part)):
            assert [i for own, _ in parts for i in own] == reference.encode_ordinary(t)


def test_the_model_is_the_vocabulary():
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    codec = bpe.Codec(bpe.serialise(ranks), bpe.np.array(sorted(ranks.values())), PATTERN)
    assert codec.pieces.get_piece_size() == len(ranks) + 1
    assert codec.bytes == {rank: token for token, rank in ranks.items()}
    assert codec.pieces.get_score(11) == -10.0
