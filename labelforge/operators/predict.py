"""Batch prediction over a table.

A predictor is a plain Python object with ``predict(batch: pandas.DataFrame)
-> list`` returning one response (or ``(content, reasoning)`` -- I5 rationale
collection, reasoning may be null) per row.  It
runs inside ``mapInPandas`` on Arrow batches; a failing batch is retried row by
row so one bad row yields an error record instead of failing the job.
Results are keyed by ``item_id`` -- never by position.
"""

from __future__ import annotations

import threading
from collections import deque
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import INFERENCE_ERROR_PREFIX, LABEL_SCHEMA, PARSING_ERROR, SKIPPED_RESPONSE
from ..functions.text import py_strip, truncate_text
from .labels import validate_label
from ..session import ship_package
from .parsing import with_strict_label

PRED_SCHEMA = "item_id long, model string, response string, reasoning string, error_type string, error_msg string"


def _error_text(e: BaseException) -> str:
    return f"{INFERENCE_ERROR_PREFIX}{type(e).__name__}: {e}"


class PartialResults(Exception):
    """A predictor may raise this to hand over what it has: ``results`` maps row
    positions of the batch to outputs.  Only rows without one are tried again."""

    def __init__(self, results: dict, cause: BaseException | None = None):
        super().__init__(str(cause) if cause else "partial results")
        self.results = results


class PredictorDown(Exception):
    """A predictor raises this when it cannot go on at all (quota, lost service): the
    job fails instead of turning every further row into an error record."""


_INSTANCES: dict[str, object] = {}      # of this Python worker, by predictor name
_BUILDING = threading.Lock()


class PerWorker:
    """A predictor that ``factory`` builds once in each Python worker, which all tasks the
    worker runs then use; only the factory travels.  ``name`` is the model's name; a
    factory of another version needs another ``version``.  The worker keeps one
    instance per name."""

    def __init__(self, name: str, factory: Callable[[], object], version: str = ""):
        self.name, self.factory, self.version = name, factory, version

    def predict(self, pdf: pd.DataFrame) -> list:
        with _BUILDING:
            held = _INSTANCES.get(self.name)
            if held is None or held[0] != self.version:
                factory = cloudpickle.loads(self.factory.value) if isinstance(self.factory, Broadcast) else self.factory
                held = _INSTANCES[self.name] = (self.version, factory())
        return held[1].predict(pdf)

    def shipped(self, spark) -> PerWorker:
        """The same with its factory sent to every executor once."""
        return PerWorker(self.name, spark.sparkContext.broadcast(cloudpickle.dumps(self.factory)), self.version)


def _whole_executor(spark):
    """A resource profile under which an executor runs one task at a time."""
    from pyspark.resource import ResourceProfileBuilder, TaskResourceRequests
    cores = int(spark.conf.get("spark.executor.cores", "1"))
    return ResourceProfileBuilder().require(TaskResourceRequests().cpus(cores)).build


def _run_batch(predictor, pdf: pd.DataFrame) -> pd.DataFrame:
    n = len(pdf)
    resp, reas, et, em = [None] * n, [None] * n, [None] * n, [None] * n

    def put(i, out):
        if isinstance(out, tuple):
            resp[i], reas[i] = out[0], out[1]
        else:
            resp[i] = out
    try:
        outs = predictor.predict(pdf)
        if len(outs) != n:
            raise ValueError(f"predictor returned {len(outs)} results for {n} rows")
        for i, o in enumerate(outs):
            put(i, o)
    except PredictorDown:
        raise
    except Exception as failure:
        # Isolate failures: rerun what has no result row by row, keep going past bad rows.
        done = dict(failure.results) if isinstance(failure, PartialResults) else {}
        for i, o in done.items():
            put(i, o)
        for i in range(n):
            if i in done:
                continue
            row = pdf.iloc[i:i + 1]
            try:
                put(i, predictor.predict(row)[0])
            except PredictorDown:
                raise
            except Exception as e:  # noqa: BLE001 - per-row capture is the contract
                resp[i], et[i], em[i] = _error_text(e), type(e).__name__, str(e)
    return pd.DataFrame({"item_id": pdf["item_id"].astype("int64").values,
                         "model": getattr(predictor, "name", "model"),
                         "response": resp, "reasoning": reas, "error_type": et, "error_msg": em})


def batch_predict(items: DataFrame, predictor, input_cols: list[str] | None = None,
                  max_workers: int | None = None, threads_per_task: int = 1,
                  batch_rows: int = 64, exclusive: bool = False) -> DataFrame:
    """I1 + I2: run ``predictor`` over every row.

    ``max_workers`` bounds global concurrency: at most that many batches run at
    once, on ``threads_per_task`` threads (or fewer, if the bound is below) of each
    of the partitions the input is spread over.  ``None`` keeps the input
    partitioning.  A task holds at most two batches per thread.
    ``exclusive`` is for predictors that need a machine's device to themselves: an
    executor runs one task at a time, on one thread (in local mode one task in all).
    ``predictor=None`` yields the skip response (I6).
    """
    cols = input_cols or items.columns
    x = items.select(*cols)
    if predictor is None:
        return x.select(F.col("item_id").cast("long"), F.lit("none").alias("model"),
                        F.lit(SKIPPED_RESPONSE).alias("response"),
                        *[F.lit(None).cast("string").alias(c) for c in ["reasoning", "error_type", "error_msg"]])
    ship_package(items.sparkSession)
    if isinstance(predictor, PerWorker):
        predictor = predictor.shipped(items.sparkSession)
    threads = 1 if exclusive else max(1, threads_per_task)
    if max_workers:
        threads = min(threads, max_workers)
        x = x.repartition(max(1, max_workers // threads))

    def run(it):
        def chunks():
            for pdf in it:
                for s in range(0, len(pdf), batch_rows):
                    yield pdf.iloc[s:s + batch_rows]
        if threads == 1:
            for chunk in chunks():
                yield _run_batch(predictor, chunk)
        else:
            with ThreadPoolExecutor(max_workers=threads) as ex:
                waiting = deque()
                for chunk in chunks():
                    if len(waiting) >= 2 * threads:      # the input is read no further than this
                        yield waiting.popleft().result()
                    waiting.append(ex.submit(_run_batch, predictor, chunk))
                while waiting:
                    yield waiting.popleft().result()
    if not exclusive:
        return x.mapInPandas(run, PRED_SCHEMA)
    if items.sparkSession.sparkContext.master.startswith("local") and "cluster" not in items.sparkSession.sparkContext.master:
        return x.repartition(1).mapInPandas(run, PRED_SCHEMA)
    return x.mapInPandas(run, PRED_SCHEMA, profile=_whole_executor(items.sparkSession))


def prediction_records(items: DataFrame, responses: DataFrame, models: list[str],
                       labels: list[str] | None = None, label_col: str = "label") -> DataFrame:
    """One record per (item, model): strict parse + schema validation;
    unparsed / invalid / never-predicted -> PARSING_ERROR; response truncated.

    ``items``: (item_id, label, ...); ``responses``: (item_id, model, response).
    Every item gets a record for every model in ``models`` (those never
    reached are pre-filled as PARSING_ERROR), as in the sequential runner.
    """
    labels = LABEL_SCHEMA if labels is None else labels
    frame = items.select("item_id", F.col(label_col).alias("true_label"),
                         F.explode(F.array(*[F.lit(m) for m in models])).alias("model"))
    parsed = with_strict_label(responses.select("item_id", "model", "response"), "response", "_lab")
    pred = F.coalesce(validate_label(F.col("_lab"), labels), F.lit(PARSING_ERROR))
    r = parsed.select("item_id", "model", pred.alias("pred_label"),
                      truncate_text("response").alias("response"))
    out = frame.join(r, ["item_id", "model"], "left")
    return out.select("item_id", "model", "true_label",
                      F.coalesce("pred_label", F.lit(PARSING_ERROR)).alias("pred_label"),
                      F.coalesce("response", F.lit("")).alias("response"))


def completion(full: Column, prompt: Column) -> Column:
    """I4: generated text = decoded output minus the prompt's length, stripped."""
    return py_strip(F.substring(full, F.length(prompt) + 1, F.lit(2147483647)))
