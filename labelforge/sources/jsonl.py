"""JSONL sources and sinks (S1-S5) and the Parquet hand-off.

Reads are strict: every line, blank ones included, must be one JSON object
whose values fit the schema, as with a line-by-line ``json.loads``.  Spark's
JSON reader skips blank lines and nulls what does not fit, so lines are read as
text and checked in the same plan that parses them: a bad line fails the job
from inside the scan.  Only then a second pass finds its file and line number.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.constants import SPLIT_FILE_SUFFIX
from ..functions.jsonexpr import strict_json_ok
from ..session import apply_required_conf
from . import publish

CLAUSE_SCHEMA = ("item_id long, split string, clause string, clause_with_context string, "
                 "contract_type string, label string, rationale string, reasoning_trace string, "
                 "model string, temperature double, top_p double")

_BAD_LINE = "LABELFORGE_INVALID_JSONL_LINE"
_CORRUPT = "__corrupt"
T = TypeVar("T")


class DatasetError(ValueError):
    def __init__(self, message: str, file_path: str | None = None, line: int | None = None,
                 expected_format: str = "JSONL", actual_format: str | None = None):
        super().__init__(message)
        self.file_path, self.line = file_path, line
        self.expected_format, self.actual_format = expected_format, actual_format


def _hadoop_exists(spark: SparkSession, path: str) -> bool:
    fs, p = publish.hadoop(spark, path)
    return bool(fs.globStatus(p)) if "*" in path else bool(fs.exists(p))


def _parsed(value: Column, schema: str | StructType) -> tuple[Column, Column]:
    """(parsed struct, whether the line is a JSON object that fits ``schema``)."""
    ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    r = F.from_json(value, f"{ddl}, {_CORRUPT} string", {"columnNameOfCorruptRecord": _CORRUPT})
    ok = strict_json_ok(value) & F.btrim(value, F.lit(" \t\r\n")).startswith("{") & r[_CORRUPT].isNull()
    return r, F.coalesce(ok, F.lit(False))


def _first_bad_line(spark: SparkSession, path: str, schema: str | StructType) -> tuple[str, int]:
    """Second pass, run only after a failure: the first bad (file, 1-based line).

    Line numbers come from per-block line counts (one row per file block),
    running offsets over the blocks of each file, and the row's position in
    its block -- no driver-side scan and no single-task sort of the data.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
        F.spark_partition_id().alias("pid"), F.monotonically_increasing_id().alias("mid"))
    blocks = lines.groupBy("f", "b", "pid").agg(F.min("mid").alias("m0"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("f").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("f", "b", "pid", "m0", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("off"))
    bad = lines.filter(~_parsed(F.col("value"), schema)[1]).join(blocks, ["f", "b", "pid"])  # one row per file split
    first = (bad.select("f", (F.col("off") + F.col("mid") - F.col("m0") + 1).alias("line"))
             .orderBy("f", "line").first())
    return first["f"], int(first["line"])


def read_jsonl(spark: SparkSession, path: str, schema: str | StructType = CLAUSE_SCHEMA,
               strict: bool = True) -> DataFrame:
    """Strict JSONL scan with a fixed schema; ``path`` may be a directory.

    Lazy and one pass: a line that is no JSON object, or whose values do not fit
    the schema, fails the action that reads it; run that action through
    ``checked`` for a ``DatasetError`` naming file and line.  Keys outside the
    schema are not read.
    """
    if not _hadoop_exists(spark, path):
        raise DatasetError(f"Data file not found: {path}", file_path=path)
    apply_required_conf(spark)
    r, ok = _parsed(F.col("value"), schema)
    if strict:
        r = F.when(ok, r).otherwise(F.raise_error(F.concat(F.lit(f"{_BAD_LINE}: "), F.substring("value", 1, 200))))
    return spark.read.text(path).select(r.alias("r")).select("r.*").drop(_CORRUPT)


def checked(spark: SparkSession, path: str, action: Callable[[], T], schema: str | StructType = CLAUSE_SCHEMA) -> T:
    """``action()``; when it fails on a bad line of ``path``, a ``DatasetError``
    with the file and line number (found by a second pass)."""
    try:
        return action()
    except Exception as e:  # noqa: BLE001 - re-raised below unless it is our marker
        if _BAD_LINE not in str(e):
            raise
    f, line = _first_bad_line(spark, path, schema)
    raise DatasetError(f"Invalid JSON on line {line} in {f}", file_path=f, line=line, actual_format="Invalid JSON")


def split_paths(spark: SparkSession, data_dir: str) -> dict[str | None, str]:
    """Split value -> path of its JSON lines in the dataset's last committed run."""
    base = data_dir.rstrip("/")
    state = publish.manifest(spark, base)
    return {s["split"]: f"{base}/{s['path']}" for s in state["splits"]} if state else {}


def full_path(spark: SparkSession, data_dir: str) -> str:
    """Path of all rows of the dataset's last committed run, or of a plain ``full_...`` file."""
    base = data_dir.rstrip("/")
    state = publish.manifest(spark, base)
    return f"{base}/{state['run']}" if state else f"{base}/full{SPLIT_FILE_SUFFIX}"


def require_splits(spark: SparkSession, data_dir: str, splits=("train", "validation")) -> dict:
    """Existence checks for the data directory and each split: the last committed run,
    or, in a folder without one, plain ``<split>_data_with_rationales.jsonl`` files."""
    if not _hadoop_exists(spark, data_dir):
        raise DatasetError(f"Data directory not found: {data_dir}", file_path=data_dir)
    base = data_dir.rstrip("/")
    committed = publish.manifest(spark, base) is not None
    there = split_paths(spark, base)
    out = {}
    for s in splits:
        p = there.get(s, f"{base}/{s}{SPLIT_FILE_SUFFIX}")
        if s not in there and (committed or not _hadoop_exists(spark, p)):
            raise DatasetError(f"{s} data file not found: {p}", file_path=p)
        out[s] = p
    return out


def is_written(spark: SparkSession, data_dir: str) -> bool:
    """Whether the folder holds a committed run or any plain ``*_data_with_rationales.jsonl``."""
    base = data_dir.rstrip("/")
    return publish.manifest(spark, base) is not None or _hadoop_exists(spark, f"{base}/*{SPLIT_FILE_SUFFIX}")


def write_jsonl(df: DataFrame, data_dir: str, overwrite: bool = False) -> bool:
    """S3 + S4: one JSONL dataset per split, and all of them together (``full_path``).

    All splits are written by one job, whatever they are called and however many
    there are (null and empty ones included), into a folder of the run's own; one small
    manifest then makes it the dataset (see ``publish``).  A job that fails midway
    leaves what was there before.  Without ``overwrite`` nothing is written when the folder
    holds a dataset.  Nulls are written as JSON nulls.  Returns whether it wrote.
    """
    spark, base = df.sparkSession, data_dir.rstrip("/")
    if not overwrite and is_written(spark, base):
        return False
    publish.commit(spark, base, publish.write_run(df, base))
    return True


def json_line(df: DataFrame) -> F.Column:
    """The serialized JSON line of each row (nulls kept)."""
    return F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})


def format_size(b: F.Column) -> F.Column:
    """Readable size: bytes / KB / MB / GB / TB, 2 decimals, steps of 1024."""
    units = ["bytes", "KB", "MB", "GB"]
    e = F.concat(F.format_string("%.2f", b / F.lit(1024.0 ** 4)), F.lit(" TB"))
    for i in reversed(range(len(units))):
        v = b / F.lit(1024.0 ** i)
        e = F.when(v < 1024.0, F.concat(F.format_string("%.2f", v), F.lit(" " + units[i]))).otherwise(e)
    return e


def split_manifest(df: DataFrame) -> DataFrame:
    """Rows, bytes and readable size per split, bytes = serialized lines + newline."""
    line_bytes = F.octet_length(json_line(df)) + 1
    g = df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.sum(line_bytes).alias("bytes"))
    return g.select("split", F.col("rows").cast("long"), F.col("bytes").cast("long"),
                    format_size(F.col("bytes").cast("double")).alias("size_text"))


def handoff(df: DataFrame, path: str) -> DataFrame:
    """Materialise a step result as Parquet and continue from the written table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def ingest_jsonl(spark: SparkSession, path: str, out_path: str,
                 schema: str | StructType = CLAUSE_SCHEMA) -> DataFrame:
    """S1 + S6 in one pass: strict-check, parse and write Parquet in a single job.

    A bad line aborts the job from inside the scan and gives a ``DatasetError``
    that names file and line.  On success the Parquet copy is returned, so later
    steps get column pruning and predicate pushdown instead of parsing text again.
    """
    parsed = read_jsonl(spark, path, schema)
    checked(spark, path, lambda: parsed.write.mode("overwrite").parquet(out_path), schema)
    return spark.read.parquet(out_path)
