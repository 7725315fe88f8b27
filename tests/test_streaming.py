"""Streaming parse + running pair counts equal the batch result."""

import os
import tempfile

from labelforge.operators import metrics as E
from labelforge.operators import parsing as Rp
from labelforge.plans import queries as Q
from labelforge.streaming import responses as St

from .conftest import SF_SMALL


def test_stream_pair_counts_match_batch(spark):
    resp = Q.responses(spark, SF_SMALL)
    gold = Q.clauses(spark, SF_SMALL).select("item_id", "label")
    rows = resp.join(gold, "item_id").selectExpr("item_id", "model", "label AS true_label", "response")
    src = tempfile.mkdtemp(prefix="lf-stream-src-")
    for part in range(3):                             # three arriving batches of files
        rows.filter(f"item_id % 3 = {part}").write.mode("append").parquet(src)
    stream = St.read_response_stream(spark, src, max_files_per_trigger=2)
    counts = St.stream_pair_counts(stream, labels=Q.NON_NONE)
    q = counts.writeStream.outputMode("complete").format("memory").queryName("lf_pairs") \
        .option("checkpointLocation", os.path.join(tempfile.mkdtemp(prefix="lf-stream-ck-"), "c")).start()
    try:
        q.processAllAvailable()
        got = sorted((tuple(r) for r in spark.sql("SELECT model, true_label, pred_label, n FROM lf_pairs").collect()), key=repr)
    finally:
        q.stop()
    batch = E.pair_counts(Rp.parse_diagnostics(rows, labels=Q.NON_NONE))
    want = sorted((tuple(r) for r in batch.collect()), key=repr)
    assert got == want and sum(r[3] for r in got) == 400


def test_snapshot_sink(spark):
    resp = Q.responses(spark, SF_SMALL)
    rows = resp.selectExpr("item_id", "model", "CAST(NULL AS STRING) AS true_label", "response")
    src = os.path.join(tempfile.mkdtemp(prefix="lf-stream-src-"), "in")
    rows.write.parquet(src)
    out = os.path.join(tempfile.mkdtemp(prefix="lf-stream-out-"), "pairs")
    q = St.start_pair_count_sink(St.stream_pair_counts(St.read_response_stream(spark, src)), out,
                                 os.path.join(tempfile.mkdtemp(prefix="lf-stream-ck-"), "c"))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(out).groupBy().sum("n").first()[0] == 400
