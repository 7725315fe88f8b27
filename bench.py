"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (warm runs per query, default 3).  Each query runs to completion
through the ``noop`` sink (full execution, nothing collected); the reported
time per query is the median of the warm runs.
"""

from __future__ import annotations

import glob
import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from labelforge.plans.queries import QUERIES  # noqa: E402
from labelforge.session import get_session, size_partitions  # noqa: E402
from labelforge.sources.tables import TABLES  # noqa: E402

HEADLINE = {
    "sample_eval": ["sample_eval"],                              # P2
    "prompt_sft_text": ["prompt_classify", "sft_text"],          # T1, T6
    "chat_loss_spans": ["chat_text", "loss_spans"],              # T6, T8
    "parse_diag": ["parse_diag"],                                # R3
    "metrics_confusion": ["metrics_summary", "class_report", "confusion_fixed", "confusion_used"],  # E4-E9
    "compare": ["compare_summary", "aligned"],                   # C1-C7
}


def run_once(spark, names, sf_dir, group=None):
    if group:
        spark.sparkContext.setJobGroup(group, group)
    t = time.perf_counter()
    for n in names:
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def shuffle_bytes(log_dir):
    """Shuffle bytes written per job group, read from the Spark event log."""
    stage_group, out = {}, {}
    paths = sorted(p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p))
    for path in paths:
        if os.path.basename(path).startswith("appstatus"):
            continue
        with open(path, encoding="utf-8") as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = g
                elif kind == "SparkListenerTaskEnd":
                    g = stage_group.get(ev.get("Stage ID"))
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    if g:
                        out[g] = out.get(g, 0) + int(m.get("Shuffle Bytes Written", 0))
    return out


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    log_dir = tempfile.mkdtemp(prefix="labelforge-eventlog-")
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app_name="labelforge-bench",
                        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                               "spark.eventLog.compress": "false"})
    sizing = size_partitions(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in TABLES])
    out = {}
    for key, names in HEADLINE.items():
        run_once(spark, names, sf_dir)  # warm-up (JIT, file listing, Python workers)
        out[key] = round(statistics.median(run_once(spark, names, sf_dir, f"{key}#{i}") for i in range(runs)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    version = spark.version
    spark.stop()
    per_group = shuffle_bytes(log_dir)
    shuffle = {k: int(statistics.median([per_group.get(f"{k}#{i}", 0) for i in range(runs)])) for k in HEADLINE}
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "sf": sf, "cpus": cpus, "runs": runs, "spark": version,
                      "shuffle_bytes": shuffle, "input_bytes": sizing["input_bytes"],
                      "shuffle_partitions": int(sizing["spark.sql.shuffle.partitions"])}))


if __name__ == "__main__":
    main()
