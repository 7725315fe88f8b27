"""Content-addressed web archive.

An archive is two Parquet tables in the shared folder.  ``payloads`` holds the
bytes of every distinct payload once, compressed, under their SHA-256.
``headers`` holds the exact header block of every record, with the digest that
names its payload.  A record is rebuilt by joining the two and reading the
result as a WARC record; the digest of its payload is computed again and must
be the one in its header.

Of records with equal payloads of at least ``SMALLEST`` bytes the one with the
smallest page id is a response and the others revisit it.

Defined cases: null html is an empty payload; a null url is an empty target,
control characters in it are percent-encoded; rows that repeat the smallest id
and payload are all responses; a null id is written as an empty id, is never
referred to, and revisits like any other; extra columns are ignored.

Scale: payloads are combined per task before their one shuffle (a payload that
a third of all pages share crosses once per task); the joins on the digest are
plain shuffles on both sides, so adaptive execution splits a hot digest.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, map_arrow, pieces, shared_folder

SMALLEST = 100
_CONTROL = re.compile(r"[\x00-\x20\x7f]")
_HASHED = "page_id long, url string, digest string, payload_bytes long, packed binary"
_READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _hash(batches):
    pack = zstandard.ZstdCompressor(level=5).compress
    for whole in batches:
        for batch in pieces(whole, "html"):
            payloads = as_bytes(batch.column("html"))
            urls = [_CONTROL.sub(lambda m: f"%{ord(m.group()):02X}", u or "") for u in batch.column("url").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), pa.array(urls, pa.string()),
                 pa.array([hashlib.sha256(p).hexdigest() for p in payloads]),
                 pa.array([len(p) for p in payloads], pa.int64()), pa.array([pack(p) for p in payloads], pa.binary())],
                ["page_id", "url", "digest", "payload_bytes", "packed"])


def _line(name: str, value) -> F.Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def _record_id(page) -> F.Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))


def write_archive(pages: DataFrame, path: str) -> None:
    """Write one record per row of (page_id, url, html) under ``path``."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"))
    hashed = map_arrow(pages, _hash, _HASHED)
    hashed.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.first("packed").alias("packed"),
                                 F.first("payload_bytes").alias("payload_bytes")).write.parquet(f"{path}/payloads")
    first = pages.sparkSession.read.parquet(f"{path}/payloads").filter(F.col("payload_bytes") >= SMALLEST).select(
        "digest", "first_id")
    named = hashed.drop("packed").join(first, "digest", "left")
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("first_id").isNotNull(), F.lit(False))
    kind = F.when(revisit, "revisit").otherwise("response")
    block = F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", kind), _line("WARC-Record-ID", _record_id(F.col("page_id"))),
        _line("WARC-Target-URI", F.col("url")), _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, _line("WARC-Refers-To", _record_id(F.col("first_id")))).otherwise(F.lit("")),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.col("payload_bytes").cast("string")), F.lit("\r\n"))
    named.select("digest", F.encode(block, "UTF-8").alias("header")).write.parquet(f"{path}/headers")


def rebuild(header: bytes, packed: bytes) -> bytes:
    """The original record: header block, payload, two line ends."""
    return header + zstandard.ZstdDecompressor().decompress(packed) + b"\r\n\r\n"


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one record; its length and digest must hold."""
    block, _, rest = record.partition(b"\r\n\r\n")
    lines = block.decode("utf-8").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    length = int(fields["Content-Length"])
    payload = rest[:length]
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"record {fields['WARC-Record-ID']}: wrong length")
    if "sha256:" + hashlib.sha256(payload).hexdigest() != fields["WARC-Payload-Digest"]:
        raise ValueError(f"record {fields['WARC-Record-ID']}: wrong payload digest")
    return fields, payload


def _page(record_id: str | None) -> int | None:
    number = record_id.removeprefix("<urn:page:").removesuffix(">") if record_id else ""
    return int(number) if number else None


def _joined(spark: SparkSession, path: str) -> DataFrame:
    headers = spark.read.parquet(f"{path}/headers")
    return headers.join(spark.read.parquet(f"{path}/payloads").select("digest", "packed"), "digest")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of
    every record, read from the rebuilt records."""
    def run(batches):
        for whole in batches:
            for batch in pieces(whole, "packed", 2 << 20):
                rows = []
                for header, packed in zip(batch.column("header").to_pylist(), batch.column("packed").to_pylist()):
                    fields, payload = parse_record(rebuild(header, packed))
                    rows.append((_page(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], len(payload),
                                 hashlib.sha256(payload).hexdigest(), fields["WARC-Type"], _page(fields.get("WARC-Refers-To"))))
                types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                    ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])
    return map_arrow(_joined(spark, path), run, _READ)


def records(spark: SparkSession, path: str) -> DataFrame:
    """(record): the bytes of every original record."""
    def run(batches):
        for whole in batches:
            for batch in pieces(whole, "packed", 2 << 20):
                pairs = zip(batch.column("header").to_pylist(), batch.column("packed").to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array([rebuild(h, p) for h, p in pairs], pa.binary())], ["record"])
    return map_arrow(_joined(spark, path), run, "record binary")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write an archive of ``pages`` in the shared folder and read it back."""
    spark = pages.sparkSession
    path = shared_folder(spark, "archive")
    write_archive(pages, path)
    return read_archive(spark, path)
