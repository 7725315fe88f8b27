"""JSONL sources/sinks (strict reads, write guard, manifest) and batch prediction."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from labelforge.operators import predict as I
from labelforge.plans import queries as Q
from labelforge.sources import jsonl as S

from .conftest import SF_SMALL


def _write(path, lines):
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_strict_read_reports_line(spark):
    d = tempfile.mkdtemp(prefix="lf-jsonl-")
    p = os.path.join(d, "x.jsonl")
    _write(p, ['{"item_id": 1, "label": "A"}', '{"item_id": 2, "label": "Ω"}', "{bad json", '{"item_id": 4}'])
    with pytest.raises(S.DatasetError) as e:
        S.checked(spark, p, lambda: S.read_jsonl(spark, p).collect())
    assert e.value.line == 3 and e.value.file_path.endswith("x.jsonl")


def test_blank_line_is_an_error(spark):
    d = tempfile.mkdtemp(prefix="lf-jsonl-")
    p = os.path.join(d, "x.jsonl")
    _write(p, ['{"item_id": 1}', "", '{"item_id": 3}'])
    with pytest.raises(S.DatasetError) as e:
        S.checked(spark, p, lambda: S.read_jsonl(spark, p).collect())
    assert e.value.line == 2


def test_values_that_do_not_fit_are_errors_and_json_white_space_is_not(spark):
    d = tempfile.mkdtemp(prefix="lf-jsonl-")
    p = os.path.join(d, "x.jsonl")
    _write(p, ['\t{"item_id": 1, "reasoning_trace": "t"} ', '{"item_id": "abc"}'])
    with pytest.raises(S.DatasetError) as e:
        S.checked(spark, p, lambda: S.read_jsonl(spark, p).collect())
    assert e.value.line == 2
    _write(p, ['\t{"item_id": 1, "reasoning_trace": "t"} '])
    assert S.read_jsonl(spark, p).select("item_id", "reasoning_trace").collect() == [(1, "t")]


def test_many_splits_and_a_null_split_are_all_written_and_guarded(spark):
    rows = [(i, None if i == 66 else f"s{i}") for i in range(67)]
    df = spark.createDataFrame(rows, "item_id long, split string")
    out = os.path.join(tempfile.mkdtemp(prefix="lf-out-"), "data")
    assert S.write_jsonl(df, out) is True
    back = S.read_jsonl(spark, S.full_path(spark, out), "item_id long, split string")
    assert sorted(map(tuple, back.collect())) == rows
    paths = S.split_paths(spark, out)
    assert set(paths) == {r[1] for r in rows}
    assert [tuple(r) for r in S.read_jsonl(spark, paths[None], "item_id long, split string").collect()] == [rows[66]]
    # another split's file in the folder guards it as a whole
    assert S.write_jsonl(df.filter("split = 's1'").withColumn("split", F.lit("new")), out) is False


def _rows(spark, out):
    return {split: sorted(r["item_id"] for r in S.read_jsonl(spark, path, "item_id long").collect())
            for split, path in S.split_paths(spark, out).items()}


def test_a_write_that_dies_leaves_the_old_data_and_is_not_seen(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="lf-out-"), "data")
    old = spark.createDataFrame([(1, "full"), (2, "a/b"), (3, "a:b"), (4, ""), (5, None), (6, "x" * 300), (7, "full")],
                                "item_id long, split string")
    broken = spark.range(100).select(F.col("id").alias("item_id"), F.lit("full").alias("split")).withColumn(
        "label", F.when(F.col("item_id") == 90, F.raise_error(F.lit("died"))).otherwise("x"))
    with pytest.raises(Exception, match="died"):
        S.write_jsonl(broken, out)
    assert not S.is_written(spark, out) and S.split_paths(spark, out) == {}
    assert S.write_jsonl(old, out) is True
    want = {"full": [1, 7], "a/b": [2], "a:b": [3], "": [4], None: [5], "x" * 300: [6]}
    assert _rows(spark, out) == want
    with pytest.raises(Exception, match="died"):
        S.write_jsonl(broken, out, overwrite=True)
    assert _rows(spark, out) == want and S.write_jsonl(old, out) is False
    assert set(S.require_splits(spark, out, ("a:b", "full", ""))) == {"a:b", "full", ""}
    with pytest.raises(S.DatasetError):
        S.require_splits(spark, out, ("a%3Ab",))
    # three more writes: the dataset is the last one, the one before stays for readers that have begun
    for n in range(3):
        before = S.split_paths(spark, out)
        assert S.write_jsonl(old.filter(F.col("item_id") <= n + 1), out, overwrite=True)
        assert all(os.path.isdir(p) for p in before.values())
    assert _rows(spark, out) == {"full": [1], "a/b": [2], "a:b": [3]}
    assert sum(x.startswith("_manifest") for x in os.listdir(out)) == 1


def test_plain_files_of_other_writers_are_read_and_guarded(spark):
    d = tempfile.mkdtemp(prefix="lf-plain-")
    _write(os.path.join(d, "train_data_with_rationales.jsonl"), ['{"item_id": 1}'])
    p = S.require_splits(spark, d, ("train",))["train"]
    assert S.read_jsonl(spark, p, "item_id long").collect() == [(1,)]
    assert S.write_jsonl(spark.createDataFrame([(2, "train")], "item_id long, split string"), d) is False


def test_valid_file_and_missing_keys(spark):
    d = tempfile.mkdtemp(prefix="lf-jsonl-")
    p = os.path.join(d, "x.jsonl")
    _write(p, ['{"item_id": 1, "label": null, "clause": "é"}', '{"item_id": 2}'])
    rows = {r["item_id"]: r for r in S.read_jsonl(spark, p).collect()}
    assert rows[1]["label"] is None and rows[1]["clause"] == "é" and rows[2]["clause"] is None


def test_missing_path(spark):
    with pytest.raises(S.DatasetError):
        S.read_jsonl(spark, "/nonexistent/dir/x.jsonl")
    with pytest.raises(S.DatasetError):
        S.require_splits(spark, tempfile.mkdtemp(prefix="lf-empty-"))


def test_write_guard_and_roundtrip(spark):
    c = Q.clauses(spark, SF_SMALL).select("item_id", "split", "clause", "contract_type", "label")
    out = os.path.join(tempfile.mkdtemp(prefix="lf-out-"), "data")
    assert S.write_jsonl(c, out) is True
    assert S.write_jsonl(c, out) is False               # any existing split file -> skip all
    back = S.read_jsonl(spark, S.full_path(spark, out),
                        "item_id long, split string, clause string, contract_type string, label string")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, c.collect()))


def test_manifest_sizes(spark):
    c = Q.clauses(spark, SF_SMALL).select("item_id", "split", "label")
    m = {r["split"]: r for r in S.split_manifest(c).collect()}
    assert sum(r["rows"] for r in m.values()) == 200
    assert all(r["size_text"].endswith(("bytes", "KB")) for r in m.values())


class Flaky:
    name = "flaky"

    def predict(self, pdf):
        out = []
        for i in pdf["item_id"]:
            if i % 5 == 0:
                raise ValueError(f"bad {i}")
            out.append((f'{{"label": "Insurance", "n": {i}}}', f"because {i}"))
        return out


def test_failures_are_isolated(spark):
    items = spark.range(40).select(F.col("id").alias("item_id"))
    out = I.batch_predict(items, Flaky(), max_workers=4, threads_per_task=2, batch_rows=7)
    rows = {r["item_id"]: r for r in out.collect()}
    assert len(rows) == 40
    assert rows[5]["response"] == "Error during inference: ValueError: bad 5" and rows[5]["error_type"] == "ValueError"
    assert rows[6]["reasoning"] == "because 6" and rows[6]["error_type"] is None


def test_prediction_records_prefill_missing(spark):
    items = spark.createDataFrame([(1, "Insurance"), (2, None)], "item_id long, label string")
    resp = spark.createDataFrame([(1, "a", '{"label": "Insurance"}')], "item_id long, model string, response string")
    r = {(x["item_id"], x["model"]): x for x in I.prediction_records(items, resp, ["a", "b"]).collect()}
    assert r[(1, "a")]["pred_label"] == "Insurance"
    assert r[(1, "b")]["pred_label"] == "PARSING_ERROR" and r[(1, "b")]["response"] == ""
    assert r[(2, "a")]["true_label"] is None


def test_completion_by_length(spark):
    d = spark.createDataFrame([("PROMPT", "PROMPT  answer \n")], "p string, f string")
    assert d.select(I.completion(F.col("f"), F.col("p"))).first()[0] == "answer"


def test_ingest_single_pass(spark):
    d = tempfile.mkdtemp(prefix="lf-jsonl-")
    p = os.path.join(d, "x.jsonl")
    _write(p, ['{"item_id": 1, "label": "A"}', '{"item_id": 2}'])
    out = S.ingest_jsonl(spark, p, os.path.join(d, "pq"))
    assert sorted(r["item_id"] for r in out.collect()) == [1, 2]
    _write(p, ['{"item_id": 1}', '{"item_id": 2,}', '{"item_id": 3}'])
    with pytest.raises(S.DatasetError) as e:
        S.ingest_jsonl(spark, p, os.path.join(d, "pq2"))
    assert e.value.line == 2


def test_small_operators(spark):
    from labelforge.operators import prompts as T
    from labelforge.operators import records as Fr
    d = spark.createDataFrame([(1, "x" * 600, "P")], "item_id long, response string, text string")
    assert len(Fr.truncate_responses(d).first()["response"]) == 503
    assert Fr.only_text(d).columns == ["text"]
    m = d.select(T.api_messages(F.col("text")).alias("m")).first()["m"]
    assert [(x["role"], x["content"]) for x in m] == [("user", "P")]
    out = S.handoff(d, os.path.join(tempfile.mkdtemp(prefix="lf-handoff-"), "t"))
    assert out.count() == 1 and out.columns == d.columns


def test_size_partitions(spark):
    from labelforge.session import size_partitions
    keys = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.files.maxPartitionBytes"]
    before = {k: spark.conf.get(k) for k in keys}
    try:
        s = size_partitions(spark, ["/root/testdata/sf0.1/documents.parquet"], target_bytes=1 << 20)
        assert s["input_bytes"] > 10 << 20
        assert int(s["spark.sql.shuffle.partitions"]) >= s["input_bytes"] * 3 // (1 << 20)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


class Dying:
    """Notes every item it is asked for; goes down once it has answered ``after`` of them."""
    name = "m"

    def __init__(self, folder, after):
        self.folder, self.after = folder, after

    def predict(self, pdf):
        out = []
        for i in pdf["item_id"]:
            if len(os.listdir(self.folder)) >= self.after:
                raise I.PredictorDown("gone")
            open(os.path.join(self.folder, str(i)), "x").close()
            out.append(f'{{"label": "Insurance", "n": {i}}}')
        return out


def test_a_run_that_dies_is_taken_up_where_it_stopped(spark):
    from labelforge.operators import ledger as G
    items = spark.range(200).select(F.col("id").alias("item_id"), F.lit("Insurance").alias("label"))
    book, first, second = (tempfile.mkdtemp(prefix="lf-ledger-") for _ in range(3))
    with pytest.raises(Exception, match="gone"):
        G.predict_resumable(items.coalesce(1), Dying(first, 100), book, "m", n_units=10)
    kept = {r["item_id"] for r in G.read_ledger(spark, book).collect()}
    assert 60 < len(kept) <= 100                                  # all units but the one it died in
    # rows never reached are filled
    early = I.prediction_records(items, G.read_ledger(spark, book), ["m"])
    assert early.count() == 200 and early.filter("pred_label = 'PARSING_ERROR'").count() == 200 - len(kept)
    got = {r["item_id"]: r for r in G.predict_resumable(items, Dying(second, 10**6), book, "m", n_units=10).collect()}
    assert {int(x) for x in os.listdir(second)} == set(range(200)) - kept
    assert len(got) == 200 and all(got[i]["run"] == (1 if i in kept else 2) for i in got)
    whole = {r["item_id"]: r["response"] for r in I.batch_predict(items, Dying(tempfile.mkdtemp(), 10**6)).collect()}
    assert {i: r["response"] for i, r in got.items()} == whole
    # a third run asks for nothing; another model has its own keys
    third = tempfile.mkdtemp(prefix="lf-ledger-")
    assert G.predict_resumable(items, Dying(third, 0), book, "m").count() == 200 and os.listdir(third) == []
    assert G.read_ledger(spark, book).filter("model = 'other'").count() == 0


def test_errors_are_asked_again_when_wanted(spark):
    from labelforge.operators import ledger as G
    items = spark.range(20).select(F.col("id").alias("item_id"))
    book = tempfile.mkdtemp(prefix="lf-ledger-")
    a = G.predict_resumable(items, Flaky(), book, "flaky", n_units=2)
    assert a.filter("error_type IS NOT NULL").count() == 4
    seen = tempfile.mkdtemp(prefix="lf-ledger-")
    fixed = Dying(seen, 10**6)
    fixed.name = "flaky"
    b = {r["item_id"]: r for r in G.predict_resumable(items, fixed, book, "flaky", n_units=2, retry_errors=True).collect()}
    assert {int(x) for x in os.listdir(seen)} == {0, 5, 10, 15} and all(r["error_type"] is None for r in b.values())
    assert b[5]["run"] == 2 and b[6]["run"] == 1


class _Built:
    """Notes where it was built."""

    def __init__(self, folder):
        open(os.path.join(folder, f"{os.getpid()}-{id(self)}-{os.urandom(4).hex()}"), "x").close()

    def predict(self, pdf):
        return [str(os.getpid())] * len(pdf)


def test_a_predictor_is_built_once_per_worker(spark):
    folder = tempfile.mkdtemp(prefix="lf-built-")
    items = spark.range(400).select(F.col("id").alias("item_id")).repartition(40)
    p = I.PerWorker("built", lambda: _Built(folder), version=folder)
    workers = {r["response"] for _ in range(2) for r in I.batch_predict(items, p, batch_rows=3).collect()}
    built = [x.split("-")[0] for x in os.listdir(folder)]
    assert len(built) == len(set(built)) and workers <= set(built) and len(built) < 40


class _Alone:
    name = "alone"

    def __init__(self, path):
        self.path = path

    def predict(self, pdf):
        fd = os.open(self.path, os.O_CREAT | os.O_EXCL)            # fails while another task holds it
        try:
            return ["ok"] * len(pdf)
        finally:
            os.close(fd)
            os.unlink(self.path)


def test_an_exclusive_predictor_has_one_task_at_a_time(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="lf-alone-"), "lock")
    items = spark.range(300).select(F.col("id").alias("item_id")).repartition(8)
    out = I.batch_predict(items, _Alone(path), batch_rows=5, threads_per_task=4, exclusive=True)
    assert {r["response"] for r in out.collect()} == {"ok"}


def test_counts_come_from_the_job_that_draws_the_sample(spark):
    from labelforge.operators import records as Fr
    from labelforge.operators import sampling as P
    rows = [(i, "NONE" if i % 3 == 0 else " none " if i % 7 == 0 else "A") for i in range(100)]
    df = spark.createDataFrame(rows, "item_id long, label string")
    kept, seen = Fr.drop_none_observed(df)
    assert len(kept.collect()) == 66 and seen.get == {"total": 100, "excluded": 34}
    for n, loose, randomize in ((10, False, True), (0, True, False), (1000, False, False), (2000, True, True)):
        out, counts = P.sample_eval_counted(df, n, randomize, 42, loose)
        available = 56 if loose else 66
        assert counts == {"requested": n, "total": 100, "excluded": 100 - available, "available": available,
                          "sampled": min(n or 10**6, available)}
        want = (P.sample_eval_loose(df, n or 10**6) if loose and randomize else
                P.sample_eval(Fr.drop_none_loose(df) if loose else df, n, True, randomize, 42))
        assert sorted(r["item_id"] for r in out.collect()) == sorted(r["item_id"] for r in want.collect())
        assert out.count() == counts["sampled"]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and "CollectMetrics" in plan
