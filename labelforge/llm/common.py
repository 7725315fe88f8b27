"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir, ship_package

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, through Spark's reader only (any store)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder (``spark.checkpoint.dir``)
    and read it back: the lineage ends there, so a lost executor costs its own
    tasks only, and every later branch reads the same rows."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_FOLDERS: dict[str, list[str]] = {}      # by application


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder of the session."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    _FOLDERS.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return f"{folder}/{name}"


def drop_stages(spark: SparkSession) -> None:
    """Delete what ``stage`` has written for this application; call it when the
    results that read it are no longer needed."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in _FOLDERS.pop(spark.sparkContext.applicationId, []):
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def as_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null becomes empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def give_back() -> None:
    """Return freed memory to the system: Python workers outlive their tasks, and
    what one operator has used would otherwise count against the next one."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):       # glibc only
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with this package present on the executors; a task leaves no
    memory behind in its worker."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            give_back()
    return df.mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch, column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """``batch`` in zero-copy slices of about ``limit`` bytes of ``column`` each
    (one row at least), so Python objects of few rows exist at a time."""
    sizes = np.cumsum([len(x) for x in as_bytes(batch.column(column))] or [0])
    start = 0
    while start < batch.num_rows:
        base = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, base + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of unsigned 64-bit integers (splitmix finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
