"""Incremental evaluation over arriving response files.

Predictions for a large corpus arrive in batches (one file per finished
prediction task).  The same column-level parser used in batch (R3) runs on the
stream; per-(model, true label, predicted label) counts are kept as streaming
aggregation state, so metric tables (E5-E9) can be refreshed from the running
pair counts at any time without rescanning earlier files.

Everything is stateless per row except the pair-count aggregation, whose state
is bounded by models x labels^2.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.parsing import parse_diagnostics

RESPONSE_SCHEMA = "item_id long, model string, true_label string, response string"


def read_response_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                         schema: str = RESPONSE_SCHEMA, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming source over a folder of response files (parquet or JSON lines)."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def stream_diagnostics(stream: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """R3 over a stream: one diagnostics row per response (append mode)."""
    return parse_diagnostics(stream, labels=labels)


def stream_pair_counts(stream: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """Running pair counts (complete / update mode) -- the input of every metric table."""
    d = stream_diagnostics(stream, labels)
    return d.groupBy("model", "true_label", "pred_label").agg(F.count(F.lit(1)).alias("n"))


def start_pair_count_sink(counts: DataFrame, table_path: str, checkpoint: str, trigger_seconds: int | None = None):
    """Write the running pair counts as a parquet snapshot after every micro-batch.

    ``foreachBatch`` receives the complete aggregate each batch (small: models x
    labels^2) and overwrites the snapshot.  A reader that lists the folder during an
    overwrite can miss files; read it between batches, or again on failure.  The
    checkpoint folder must be on shared storage.
    """
    def write(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(table_path)
    w = counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(write)
    if trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()
