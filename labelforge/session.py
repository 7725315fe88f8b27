"""Spark session helpers.

The library never creates a session behind the caller's back: every operator
takes DataFrames.  ``get_session`` is a convenience for tests, the bench and the
driver entry point; on a cluster the caller's own session is used as is.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Confs the operators rely on for correct results (not tuning).
REQUIRED_CONF = {
    # json.loads keeps the last of duplicate keys; variant parsing rejects
    # duplicates unless this is on (then last wins as well).
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "labelforge", extra: dict | None = None) -> SparkSession:
    master = master or os.environ.get("LABELFORGE_MASTER", "local[8]")
    b = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # coalesce small shuffles to the advisory size instead of keeping one
        # tiny task per core (the documented recommendation for shared clusters)
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LABELFORGE_DRIVER_MEMORY", "16g"))
    )
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_required_conf(spark)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    """Set the confs the parsers need for right results, where they are not set
    (idempotent; every parser entry point calls it)."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and materialised steps.

    Reads ``spark.checkpoint.dir`` from the session (the cluster's shared
    folder).  Only when it is unset and the master is local -- tests -- a fresh
    folder under the system temp dir is chosen and recorded in the session; on a
    cluster an unset folder is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^,\]]*(,[^\]]*)?\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        d = tempfile.mkdtemp(prefix="labelforge-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``labelforge`` importable in Python workers (once per application).

    Python-side operators (``mapInPandas`` predictors) pickle objects from this
    package by reference.  On a cluster the package normally travels with
    ``--py-files``; this adds it to the context the same way when it does not.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    import shutil
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="labelforge-pyfiles-")
    archive = shutil.make_archive(os.path.join(out, "labelforge"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir="labelforge")
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def materialize(df):
    """Compute ``df`` once and cut its lineage with a reliable checkpoint in the
    shared checkpoint folder (survives executor loss; never machine-local).

    Used for small intermediate tables that several branches of a plan read --
    the pair-count table of the metric jobs -- so the scan and aggregation
    behind them run once instead of once per branch.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths`` (Hadoop FileSystem, any scheme)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        if fs.exists(hp):
            total += int(fs.getContentSummary(hp).getLength())
    return total


def size_partitions(spark: SparkSession, paths: list[str], target_bytes: int = 256 << 20,
                    expansion: float = 3.0, min_partitions: int | None = None,
                    max_partitions: int | None = None) -> dict:
    """Size shuffle and scan partitions from the input volume.

    Shuffle partitions = ceil(input bytes x ``expansion`` / ``target_bytes``)
    (columnar files grow when decoded), at least 2 x default parallelism and, if
    given, at most ``max_partitions``.  Pass the paths that feed the largest shuffle, not
    all inputs of a job: partitions then stay at ``target_bytes`` at any size.  AQE
    then coalesces small partitions towards ``target_bytes`` and splits skewed
    ones.  Scan splits are capped at ``target_bytes`` as well.  Returns the
    settings applied.
    """
    n_bytes = input_bytes(spark, paths)
    floor = min_partitions or 2 * spark.sparkContext.defaultParallelism
    shuffle = -(-int(n_bytes * expansion) // target_bytes)
    shuffle = max(floor, shuffle if max_partitions is None else min(max_partitions, shuffle))
    settings = {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    return {"input_bytes": n_bytes, **settings}
