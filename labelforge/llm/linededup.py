"""Substring dedup by hashing units of text.

A text is cut into units that cover all its characters: lines, paragraphs, or
sentences (``SENTENCE``: cut after each . ! ? and their wide forms, and after
line feeds; passages pasted into the middle of a line keep their inner
sentences whole, which lines would miss).  A unit is normalised -- ASCII case
folded, white space runs as one space, no end mark -- and every one that then holds
anything is hashed to 128 bits.  Of equal units of the whole table the earliest
occurrence (by doc_id, then row, then offset) stays, all others are repeats.  Repeats
that follow one another in a document form a run; runs of size ``MIN_SIZE`` or more are
removed as a whole, so a passage of many short sentences goes, and so does a repeated
line or paragraph, whose sentences are a run, while a short sentence alone stays.
The size of a run counts its words; a word of over ``LONG_WORD`` characters, as in
scripts without blanks, counts a fifth of them.  A removed unit keeps its offsets in
the original text.

Defined cases: null or empty text has no units; a null id ranks last; rows that
repeat an id are separate documents, ranked in row order, so of repeated rows the first
keeps its units; ids of any type that has an order; extra columns are ignored by
``find`` and kept by ``clean``.

Scale: units are written once, narrow (no text).  The earliest occurrence is a
partial aggregate, so a passage in a third of all documents is no hot key; the
join back is plain on both sides, for adaptive execution to split.  Runs and removed
units are gathered per document, whose size bounds them.
"""

from __future__ import annotations

import re
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import as_bytes, map_arrow, pieces, stage

SENTENCE = r"[^.!?\n。！？]+[.!?\n。！？]?|[.!?\n。！？]"
LINE = r"[^\n]+\n?|\n"
PARAGRAPH = r"(?s).+?(?:\n[ \t]*\n\s*|\Z)"
MIN_SIZE = 6
LONG_WORD = 20


def normalised(unit: str) -> bytes:
    """Words of a unit, ASCII case folded, without an end mark, joined by spaces."""
    return b" ".join(unit.rstrip(".!?。！？ \t\n\x0b\x0c\r").encode("utf-8", "surrogatepass").lower().split())


def units(text: str, pattern: re.Pattern) -> list[tuple[int, int, int, bytes]]:
    """(start, end, size, digest) of the units that hold anything."""
    out = []
    for m in pattern.finditer(text):
        norm = normalised(m.group())
        if not norm:
            continue
        size = sum(1 if len(w) <= LONG_WORD or (n := len(w.decode("utf-8", "surrogatepass"))) <= LONG_WORD else n // 5
                   for w in norm.split(b" "))
        out.append((m.start(), m.end(), size, blake2b(norm, digest_size=16).digest()))
    return out


def _cut(pattern: str):
    def run(batches):
        compiled = re.compile(pattern)
        for whole in batches:
            for batch in pieces(whole, "text"):
                rows = []
                for k, (row, raw) in enumerate(zip(batch.column("row").to_pylist(), as_bytes(batch.column("text")))):
                    found = units(raw.decode("utf-8", "replace"), compiled)
                    rows.append((k, row, -1, len(found), 0, 0, None))           # the document itself
                    rows += [(k, row, a, b, n, i, h) for i, (a, b, n, h) in enumerate(found)]
                of, *columns = zip(*rows)
                types = [pa.int64()] * 5 + [pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(of, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, types))],
                    ["doc_id", "row", "start", "end", "size", "place", "digest"])
    return run


def find(docs: DataFrame, pattern: str = SENTENCE, min_size: int = MIN_SIZE) -> DataFrame:
    """(row, doc_id, n_units, removed) per document of (doc_id, text); ``removed``
    holds (start, end, keeper) of each removed unit, in order, ``keeper`` the
    doc_id of the occurrence that stays."""
    return _find(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), pattern, min_size)


def _find(numbered: DataFrame, pattern: str, min_size: int) -> DataFrame:
    kind = numbered.schema["doc_id"].dataType.simpleString()
    cut = stage(map_arrow(numbered, _cut(pattern), f"doc_id {kind}, row long, start long, end long, size long, place long, digest binary"),
                "units")
    own = cut.filter("start >= 0")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row", "start")
    repeated = stage(own.groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
                     .filter("n > 1").select("digest", "first"), "repeated-units")
    later = (own.join(repeated, "digest").filter((F.col("row") != F.col("first.row")) | (F.col("start") != F.col("first.start")))
             .select("row", "start", "end", "size", "place", F.col("first.doc_id").alias("keeper")))
    # repeats that follow one another have one difference of place and rank
    run = F.col("place") - F.row_number().over(Window.partitionBy("row").orderBy("place"))
    sized = later.withColumn("run", run).withColumn("run_size", F.sum("size").over(Window.partitionBy("row", "run")))
    removed = sized.filter(F.col("run_size") >= min_size).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "keeper"))).alias("removed"))
    return cut.filter("start < 0").select("row", "doc_id", F.col("end").alias("n_units")).join(removed, "row", "left")


def report(docs: DataFrame, pattern: str = SENTENCE, min_size: int = MIN_SIZE) -> DataFrame:
    """(doc_id, n_units, n_removed, removed_chars, spans, keepers) per document:
    ``spans`` lists start:end of removed units, ``keepers`` the distinct doc_ids
    that keep them, both as text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    r = F.coalesce("removed", F.array().cast(f"array<struct<start:bigint,end:bigint,keeper:{kind}>>"))
    keepers = F.sort_array(F.array_distinct(F.filter(F.transform(r, lambda u: u["keeper"]), lambda k: k.isNotNull())))
    return find(docs, pattern, min_size).select(
        "doc_id", "n_units", F.size(r).cast("long").alias("n_removed"),
        F.aggregate(r, F.lit(0).cast("long"), lambda a, u: a + u["end"] - u["start"]).alias("removed_chars"),
        F.array_join(F.transform(r, lambda u: F.concat_ws(":", u["start"], u["end"])), ",").alias("spans"),
        F.array_join(keepers, ",").alias("keepers"))


def clean(docs: DataFrame, pattern: str = SENTENCE, min_size: int = MIN_SIZE) -> DataFrame:
    """``docs`` (all columns) with removed units cut from ``text``, and ``n_chars`` (if
    there) counted anew; every row by its own units, also where ids repeat."""
    rows = stage(docs.select("*", F.monotonically_increasing_id().alias("__lf_row")), "rows")
    found = _find(rows.select(F.col("__lf_row").alias("row"), "doc_id", "text"), pattern, min_size)
    gone = found.filter("removed is not null").select(F.col("row").alias("__lf_row"), F.col("removed").alias("__lf_removed"))

    def run(batches):
        for whole in batches:
            for batch in pieces(whole, "text"):
                text = batch.column("text").to_pylist()
                for k, spans in enumerate(batch.column("__lf_removed").to_pylist()):
                    for s in reversed(spans or []):
                        text[k] = text[k][:s["start"]] + text[k][s["end"]:]
                cols = {n: c for n, c in zip(batch.schema.names, batch.columns) if n != "__lf_removed"}
                cols["text"] = pa.array(text, batch.schema.field("text").type)
                if "n_chars" in cols:
                    cols["n_chars"] = pa.array([None if t is None else len(t) for t in text], batch.schema.field("n_chars").type)
                yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    joined = rows.join(gone, "__lf_row", "left").select(*docs.columns, "__lf_removed")
    return map_arrow(joined, run, docs.schema)
