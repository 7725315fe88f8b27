"""The archive against a plain version of its rules, and damaged archives."""

import hashlib

import pytest

from labelforge.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, payload_bytes string"


def rows():
    big, other = "<p>é " + "x" * 200, "<div>" + "y" * 300
    return ([(i, f"http://h/{i}", big) for i in (9, 4, 7, 30)] + [(i, "u", "small") for i in (1, 2)]
            + [(3, None, None), (5, "http://a b\r\nX: y", ""), (6, "v", other), (6, "v", other), (8, "v", other), (None, "n", big),
               (10, "w", "z" * 99), (11, "w", "z" * 99), (12, "w", "z" * 100), (13, "w", "z" * 100), (14, "l", "long " * 100_000)])


def plain(table):
    out = []
    for i, u, h in table:
        p = (h or "").encode()
        least = min((j for j, _, g in table if (g or "").encode() == p and j is not None), default=None)
        again = len(p) >= 100 and least is not None and i != least
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if again else "response", least if again else None))
    return out


def test_round_trip_equals_the_rules(spark):
    df = spark.createDataFrame([(*r, "d", "p") for r in rows()], SCHEMA).repartition(4)
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
           for r in warc.round_trip(df).collect()]
    assert sorted(got, key=str) == sorted(plain(rows()), key=str)
    assert warc.round_trip(df.limit(0)).collect() == []


def test_payloads_are_stored_once_and_records_are_whole(spark, tmp_path):
    df = spark.createDataFrame([(*r, "d", "p") for r in rows()], SCHEMA)
    path = f"file://{tmp_path}/archive"
    warc.write_archive(df, path)
    store = spark.read.parquet(f"{path}/payloads")
    assert store.count() == len({(h or "") for _, _, h in rows()})
    found = [warc.parse_record(bytes(r["record"])) for r in warc.records(spark, path).collect()]
    assert len(found) == len(rows())
    urls = {f["WARC-Target-URI"] for f, _ in found}
    assert "http://a%20b%0D%0AX:%20y" in urls and "" in urls
    assert sorted(p for _, p in found) == sorted((h or "").encode() for _, _, h in rows())


def test_a_damaged_payload_is_refused():
    header = (b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Payload-Digest: sha256:"
              + hashlib.sha256(b"abc").hexdigest().encode() + b"\r\nContent-Length: 3\r\n\r\n")
    assert warc.parse_record(header + b"abc\r\n\r\n")[1] == b"abc"
    for bad in (b"abd\r\n\r\n", b"ab\r\n\r\n", b"abc"):
        with pytest.raises(ValueError):
            warc.parse_record(header + bad)
