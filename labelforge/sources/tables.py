"""Reading the driver-provided parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan of one table; files are listed anew on every call."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
