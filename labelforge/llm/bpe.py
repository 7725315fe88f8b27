"""Byte-level BPE encoding and decoding with a sentencepiece model.

The model is serialised straight from a rank file: every token's bytes are
mapped to one printable character each (so a piece holds no white space), its
score is the negative rank, and normalisation is the identity.  Merging the
best-scored neighbours first is then merging by lowest rank, leftmost first,
as rank-based BPE does.  A text is cut into pre-tokens by the pattern; each is
encoded by itself, a pre-token that is a token as a whole is that token.
Decoding maps ids back to pieces and pieces back to bytes.

Defined cases: null or empty text has no tokens; texts of any length are
encoded whole, in one pass of the pattern; repeated rows agree; other columns
are ignored by ``digests`` and ``decode`` and kept by ``encode``.

Scale: map-only.  The serialised model (about 1 MB) travels in the task
closure, which Spark broadcasts; a task keeps a bounded memo of encoded chunks.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
import operator
import re
import string
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType

from .common import as_bytes, map_arrow, pieces

MEMO = 200_000   # encoded chunks a task keeps at hand
SLICE = 2 << 20   # bytes of text encoded at a time
_CHUNKS = re.compile(r" (?=\S)").split
_NORMAL, _UNKNOWN, _BPE = 1, 2, 2     # enum values of the model format


@functools.cache
def byte_characters() -> tuple[str, ...]:
    """One printable character per byte: printable Latin-1 stands for itself, the
    other bytes for the characters from U+0100 on, in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return tuple(chr(b) if b in own else chr(next(spare)) for b in range(256))


def load_ranks(path: str) -> dict[bytes, int]:
    """token bytes -> rank of a rank file (base64 and rank per line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _message(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def serialise(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece model: <unk>, then the tokens by rank (piece id = place + 1)."""
    chars = byte_characters()
    out = [_message(1, _message(1, b"<unk>\xe2\x81\x87") + b"\x15" + struct.pack("<f", 0.0) + _number(3, _UNKNOWN))]
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        piece = "".join(chars[b] for b in token).encode()
        out.append(_message(1, _message(1, piece) + b"\x15" + struct.pack("<f", -float(rank)) + _number(3, _NORMAL)))
    off = (1 << 64) - 1                                          # -1: no such piece
    trainer = (_number(3, _BPE) + _number(4, len(ranks) + 1) + _number(24, 0) + _number(40, 0) + _number(41, off)
               + _number(42, off) + _number(43, off) + _message(45, b"<unk>\xe2\x81\x87"))
    normaliser = _message(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join([*out, _message(2, trainer), _message(3, normaliser)])


class Codec:
    """Encoder and decoder over a serialised model; ``ranks`` maps piece ids to ranks.

    ``pattern`` must begin a pre-token at every space that precedes a visible
    character, as all public byte-level patterns do.  That a space and ASCII
    letters are one pre-token, and a mark after them another, is tried on the
    pattern first; where it does not hold every chunk is cut by the pattern."""

    def __init__(self, model: bytes, ranks: np.ndarray, pattern: str):
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.ranks = ranks                                        # by piece id - 1
        # white space by the Unicode property, whatever the regex library adds to it
        self.cut = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        chars = byte_characters()
        self.to_char = {b: c for b, c in enumerate(chars)}
        to_byte = {c: b for b, c in enumerate(chars)}
        n = self.pieces.get_piece_size()
        self.whole = {self.pieces.id_to_piece(i): i for i in range(1, n)}
        self.bytes = {int(ranks[i - 1]): bytes(to_byte[c] for c in piece) for piece, i in self.whole.items()}
        self.rank = [-1, *map(int, ranks)]
        self.written = list(map(str, self.rank))
        self.letters = self._keeps_letters()
        self.memo: dict[str, tuple[tuple[int, ...], str]] = {}

    def _keeps_letters(self) -> bool:
        """Whether the pattern cuts words of ASCII letters, of any case, nowhere."""
        small = string.ascii_lowercase
        words = [*string.ascii_letters, small, small.upper(), small.title(), small.swapcase() + small, small + small.upper(),
                 "".join(a + b.upper() for a, b in zip(small, small[::-1])), "s", "ll", "re", "letters" * 50]
        return all(self.cut(" " + w + mark) == [" " + w, *mark] for w in words for mark in ["", *".,;:!?"])

    def _remember(self, chunks: set[str]) -> None:
        """Encode chunks (each follows a space) into the memo, in one call."""
        space, whole, cut, to_char = self.to_char[32], self.whole.get, self.cut, self.to_char
        rank, written, memo = self.rank, self.written, self.memo
        chunks = list(chunks)
        spread: list[str] = []                  # pre-tokens of all chunks, byte-mapped
        several: dict[int, int] = {}            # place of a chunk -> how many pre-tokens, if not one
        for k, c in enumerate(chunks):
            if self.letters and c.isascii():    # letters stand for themselves
                if c.isalpha():
                    spread.append(space + c)
                    continue
                if c[-1] in ".,;:!?" and c[:-1].isalpha():
                    spread += (space + c[:-1], c[-1])
                    several[k] = 2
                    continue
            own = cut(" " + c)
            spread += [t.encode("utf-8").decode("latin-1").translate(to_char) for t in own]
            several[k] = len(own)
        found = list(map(whole, spread))
        lost = [k for k, i in enumerate(found) if i is None]
        merged = self.pieces.encode([spread[k] for k in lost], out_type=int, num_threads=1)
        ids: list = [(i,) for i in found]
        for k, own in zip(lost, merged):
            ids[k] = own
        at = 0
        for k, chunk in enumerate(chunks):
            n = several.get(k, 1)
            own = ids[at] if n == 1 else [*itertools.chain.from_iterable(ids[at:at + n])]
            at += n
            memo[chunk] = tuple([rank[i] for i in own]), ",".join([written[i] for i in own])

    def encode_all(self, texts: list[str]) -> Iterator[list[tuple[tuple[int, ...], str]]]:
        """(ids, ids as written) of the chunks of each text.

        Before a space that precedes a visible character there is always a
        border of pre-tokens, and none reads past such a border, so a text may
        be cut there and each chunk looked up by itself."""
        split = [_CHUNKS(t) for t in texts]
        first = [chunks.pop(0) for chunks in split]
        needed = set().union(*split)
        fresh = needed.difference(self.memo)
        if len(self.memo) + len(fresh) > MEMO:      # what this slice needs stays
            self.memo = {c: self.memo[c] for c in needed - fresh}
        if fresh:
            self._remember(fresh)
        for start, chunks in zip(first, split):
            head = tuple(self.rank[i] for t in self.cut(start) for i in self._whole_or_merged(t))
            yield [(head, ",".join(map(str, head)))] * bool(head) + list(map(self.memo.__getitem__, chunks))

    def _whole_or_merged(self, token: str) -> list[int]:
        mapped = token.encode("utf-8").decode("latin-1").translate(self.to_char)
        whole = self.whole.get(mapped)
        return self.pieces.encode(mapped, out_type=int) if whole is None else [whole]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


_ids, _written = operator.itemgetter(0), operator.itemgetter(1)


def _flat(parts: list[tuple[tuple[int, ...], str]]) -> list[int]:
    return list(itertools.chain.from_iterable(map(_ids, parts)))


def _model(path: str) -> tuple[bytes, np.ndarray]:
    ranks = load_ranks(path)
    return serialise(ranks), np.array(sorted(ranks.values()), np.int64)


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t.decode("utf-8", "replace") for t in as_bytes(batch.column("text"))]


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): every whole text encoded,
    its ids decoded again."""
    model, ranks = _model(path)

    def run(batches):
        codec = Codec(model, ranks, pattern)
        for whole in batches:
            for batch in pieces(whole, "text", SLICE):
                rows = []
                for parts in codec.encode_all(_texts(batch)):
                    ids = _flat(parts)
                    rows.append((len(ids), hashlib.sha256(",".join(map(_written, parts)).encode()).hexdigest(),
                                 hashlib.sha256(codec.decode(ids)).hexdigest()))
                n, a, b = zip(*rows)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a), pa.array(b)],
                                                 ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    narrow = docs.select("doc_id", "text")
    kind = dict(narrow.dtypes)["doc_id"]
    return map_arrow(narrow, run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` without ``text``, with ``ids`` (array of int) and ``n_tokens``; an
    input column of either name is replaced."""
    model, ranks = _model(path)
    kept = [c for c in docs.columns if c not in ("text", "ids", "n_tokens")]

    def run(batches):
        codec = Codec(model, ranks, pattern)
        for whole in batches:
            for batch in pieces(whole, "text", SLICE):
                ids = [_flat(parts) for parts in codec.encode_all(_texts(batch))]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in kept), pa.array([len(x) for x in ids], pa.int64()),
                     pa.array(ids, pa.list_(pa.int32()))], [*kept, "n_tokens", "ids"])

    schema = docs.select(*[f"`{c}`" for c in kept]).schema.add("n_tokens", "long").add("ids", ArrayType(IntegerType()))
    return map_arrow(docs.select(*[f"`{c}`" for c in kept], "text"), run, schema)


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, text as binary) of (doc_id, ids); null ids give empty bytes."""
    model, ranks = _model(path)

    def run(batches):
        codec = Codec(model, ranks, pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                text = [codec.decode(x or []) for x in batch.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(text, pa.binary())], ["doc_id", "text"])

    narrow = tokens.select("doc_id", "ids")
    kind = dict(narrow.dtypes)["doc_id"]
    return map_arrow(narrow, run, f"doc_id {kind}, text binary")
