"""Committed runs of a split-wise JSONL dataset.

A write puts its files under a folder of its own, ``run-<id>/_split=<code>/part-*``, and
becomes visible by one small manifest, ``_manifest-<number>.json``: split value ->
folder, in which a split's code is injective (null, empty and any character have their own).
Readers and the write guard look at the manifest with the highest number only.  A
job that dies before its manifest leaves what was there readable and does not count as
written; files are never renamed or copied, only the manifest is put in place by one rename.
"""

from __future__ import annotations

import json
import re
import urllib.parse
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_NAME = re.compile(r"_manifest-(\d{10})\.json")
_LONG = 180         # longer codes are replaced by a digest (file systems limit names)


def hadoop(spark: SparkSession, path: str):
    """(file system, path) of the Hadoop API for ``path``, whatever its store."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def split_code(split: Column) -> Column:
    """Folder name of a split value: ``n`` for null, ``s`` + the value with all but plain
    ASCII characters as ~XX bytes, or ``h`` + a digest where that is long."""
    escaped = F.url_encode(split)
    for a, b in (("*", "%2A"), ("+", "%20"), ("%", "~")):
        escaped = F.replace(escaped, F.lit(a), F.lit(b))
    code = F.concat(F.lit("s"), escaped)
    return F.when(split.isNull(), "n").when(F.length(code) > _LONG, F.concat(F.lit("h"), F.sha2(split, 256))).otherwise(code)


def _names(spark: SparkSession, folder: str, prefix: str) -> list[str]:
    fs, p = hadoop(spark, folder)
    return sorted(n for n in (x.getPath().getName() for x in fs.listStatus(p)) if n.startswith(prefix)) if fs.exists(p) else []


def _read(spark: SparkSession, path: str) -> str:
    fs, p = hadoop(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def manifest(spark: SparkSession, base: str) -> dict | None:
    """The committed manifest of the dataset, or None."""
    found = [n for n in _names(spark, base, "_manifest-") if _NAME.fullmatch(n)]
    return json.loads(_read(spark, f"{base}/{found[-1]}")) | {"file": found[-1]} if found else None


def _split_of(spark: SparkSession, folder: str, code: str) -> str | None:
    if code == "n":
        return None
    if code[0] == "s":
        return urllib.parse.unquote(code[1:].replace("~", "%"))
    return spark.read.schema("split string").json(folder).first()["split"]     # one short read per long name


def commit(spark: SparkSession, base: str, run: str, keep_runs: int = 1) -> dict:
    """Publish ``run`` as the dataset's state; of earlier runs the last ``keep_runs`` stay
    for readers that have begun."""
    last = manifest(spark, base)
    number = int(_NAME.fullmatch(last["file"])[1]) + 1 if last else 1
    folders = _names(spark, f"{base}/{run}", "_split")
    splits = [{"split": _split_of(spark, f"{base}/{run}/{f}", f.split("=", 1)[1]), "path": f"{run}/{f}"} for f in folders]
    earlier = ([last["run"], *last["earlier"]] if last else [])
    state = {"run": run, "splits": splits, "earlier": earlier[:keep_runs]}
    fs, temp = hadoop(spark, f"{base}/_commit-{uuid.uuid4().hex}")
    target = hadoop(spark, f"{base}/_manifest-{number:010d}.json")[1]
    out = fs.create(temp, True)
    out.write(bytearray(json.dumps(state, ensure_ascii=False).encode()))
    out.close()
    if fs.exists(target) or not fs.rename(temp, target):
        fs.delete(temp, False)
        raise OSError(f"another writer has committed {target.toString()}; {run} was not published")
    for gone in earlier[keep_runs:]:
        fs.delete(hadoop(spark, f"{base}/{gone}")[1], True)
    if last:
        fs.delete(hadoop(spark, f"{base}/{last['file']}")[1], False)
    return state


def write_run(df: DataFrame, base: str) -> str:
    """All rows of ``df``, one folder per split, in one job; returns the run's name.  Not
    visible before ``commit``."""
    run, column = f"run-{uuid.uuid4().hex}", "_split"
    while column in df.columns:
        column += "_"
    coded = df.withColumn(column, split_code(F.col("split")))
    coded.write.partitionBy(column).option("ignoreNullFields", "false").json(f"{base}/{run}")
    return run
