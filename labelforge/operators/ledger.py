"""Resumable prediction: an append-only ledger of results keyed by (item_id, model).

Items are dealt into units by a hash of their id.  A unit is one job that writes its results
to a folder of its own and counts once Spark's commit marker is there; a run that
dies keeps every unit that was done before.  The next run reads the ledger, takes the
items without a result (an anti-join on item_id and model) and asks for these only.  A
unit written twice by two attempts is harmless: results are read as one row per key.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from ..sources.publish import hadoop
from .predict import PRED_SCHEMA, batch_predict

LEDGER_SCHEMA = f"{PRED_SCHEMA}, run long"
_RUN = re.compile(r"/run-(\d+)-unit-\d+-[0-9a-f]+$")


def _done(spark: SparkSession, ledger: str) -> list[str]:
    """Folders of units whose write was committed."""
    fs, base = hadoop(spark, ledger)
    if not fs.exists(base):
        return []
    folders = [s.getPath().toString() for s in fs.listStatus(base) if s.isDirectory()]
    return sorted(f for f in folders if fs.exists(hadoop(spark, f"{f}/_SUCCESS")[1]))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """One row per (item_id, model): a result before an error, of these the earliest run's;
    ``run`` counts from 1."""
    done = _done(spark, ledger)
    if not done:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    rows = spark.read.schema(LEDGER_SCHEMA).parquet(*done)
    value = F.struct(F.col("error_type").isNotNull().alias("failed"), "run",
                     *[c for c in rows.columns if c not in ("item_id", "model", "run")])
    return rows.groupBy("item_id", "model").agg(F.min(value).alias("v")).select(
        "item_id", "model", *[F.col(f"v.{c}").alias(c) for c in rows.columns if c not in ("item_id", "model")])


def unit_of(n_units: int):
    """The unit of an item: a hash of its id, the same in every run."""
    return F.pmod(F.conv(F.substring(F.md5(F.col("item_id").cast("string")), 1, 8), 16, 10).cast("long"), F.lit(n_units))


def predict_resumable(items: DataFrame, predictor, ledger: str, model: str, n_units: int = 16, retry_errors: bool = False,
                      only_units: list[int] | None = None, **options) -> DataFrame:
    """I1 with a ledger: results of ``items`` (item_id unique, not null) under ``model``, asking only for
    those the ledger at ``ledger`` does not hold; the result is the ledger's rows for them.

    ``n_units`` is how many commits a whole run makes (more: less is lost when one
    dies).  ``retry_errors`` asks again for rows that hold an error.  ``only_units``
    restricts a run to some units (several jobs may share the work).  ``options`` go to
    ``batch_predict``.  A predictor stops the run by raising ``PredictorDown``.
    """
    spark, base = items.sparkSession, ledger.rstrip("/")
    known = read_ledger(spark, base).filter(F.col("model") == model)
    if retry_errors:
        known = known.filter(F.col("error_type").isNull())
    run = 1 + max((int(m[1]) for f in _done(spark, base) if (m := _RUN.search(f))), default=0)
    # what is to be asked, written once by unit: a unit's job reads its own folder only
    todo = f"{checkpoint_dir(spark)}/todo-{uuid.uuid4().hex}"
    asked = items.withColumn("_unit", unit_of(n_units).cast("int")).join(known.select("item_id"), "item_id", "left_anti")
    if only_units is not None:
        asked = asked.filter(F.col("_unit").isin(only_units))
    asked.write.partitionBy("_unit").parquet(todo)
    written = spark.read.schema(asked.schema).parquet(todo)
    for (unit,) in sorted(written.select("_unit").distinct().collect()):
        got = batch_predict(written.filter(F.col("_unit") == unit).drop("_unit"), predictor, **options)
        got.withColumn("run", F.lit(run).cast("long")).write.parquet(f"{base}/run-{run}-unit-{unit}-{uuid.uuid4().hex}")
    return read_ledger(spark, base).filter(F.col("model") == model).join(items.select("item_id"), "item_id", "left_semi")
