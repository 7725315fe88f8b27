"""Hot keys, bounded buffers and settings that a cluster depends on."""

import random
import threading
import time

import pytest
from pyspark.sql import functions as F

from labelforge.operators import metrics as E
from labelforge.operators import predict as I
from labelforge.operators import prompts as T
from labelforge.operators import ranking
from labelforge.sources.tables import read_table

from .conftest import SF_SMALL


def _render(turns):
    """(spans of assistant turns) by writing the conversation out."""
    text, spans, lead = "<bos>", [], ""
    for k, (turn, role, body) in enumerate(turns):
        if k == 0 and role == "system":
            lead = body.strip() + "\n\n"
            continue
        prefix = {"user": "<start_of_turn>user\n", "assistant": "<start_of_turn>model\n"}.get(role, f"<start_of_turn>{role}\n")
        start = len(text) + len(prefix)
        text += prefix + lead + body.strip() + "<end_of_turn>\n"
        lead = ""
        if role == "assistant":
            spans.append((turn, start, len(text)))
    return spans


def test_loss_spans_of_a_hot_conversation(spark, monkeypatch):
    r = random.Random(1)
    rows = []
    for conv in range(40):
        n = 4000 if conv == 7 else r.randrange(1, 26)
        first = r.choice(["system", "user", "assistant"])
        rows += [(conv, t, first if t == 0 else r.choice(["user", "assistant", "system"]), " " + "x" * r.randrange(0, 30))
                 for t in range(n)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    seen = []
    real = ranking.materialize
    monkeypatch.setattr(ranking, "materialize", lambda d: seen.append(real(d)) or seen[-1])
    got = {}
    for x in T.loss_span_rows(df).collect():
        got.setdefault(x["conv_id"], []).append((x["turn"], x["span_start"], x["span_end"]))
    for conv in range(40):
        turns = [(t, role, text) for c, t, role, text in rows if c == conv]
        assert sorted(got.get(conv, [])) == _render(turns), conv
    counts = [x["count"] for x in seen[0].groupBy("_pid").count().collect()]
    assert max(counts) <= 2 * sum(counts) / len(counts)      # the hot conversation lies in many tasks


def test_array_and_row_forms_of_loss_spans_agree(spark):
    c = read_table(spark, SF_SMALL, "conversations")
    a = T.turns_from_rows(c).select("conv_id", F.explode(T.loss_spans(F.col("turns"))).alias("s")).select("conv_id", "s.start", "s.end")
    b = T.loss_span_rows(c).select("conv_id", "span_start", "span_end")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


class _Counting:
    """Counts running batches and the rows handed out before the first result is used."""
    name = "counting"

    def predict(self, pdf):
        time.sleep(0.01)
        return ["x"] * len(pdf)


def test_predictor_input_is_read_in_a_bounded_window(monkeypatch):
    import pandas as pd
    pulled, frames = [0], 200

    def source():
        for k in range(frames):
            pulled[0] += 1
            yield pd.DataFrame({"item_id": [k]})

    class Frame:                                         # stands for the DataFrame: hands the mapper over
        columns, sparkSession = ["item_id"], None

        def select(self, *_):
            return self

        def repartition(self, n):
            self.n = n
            return self

        def mapInPandas(self, fn, schema):
            return fn
    monkeypatch.setattr(I, "ship_package", lambda spark: None)
    f = Frame()
    out = I.batch_predict(f, _Counting(), max_workers=5, threads_per_task=8)(source())
    assert f.n == 1                                      # five workers: one partition of five threads, not eight
    next(out)
    assert pulled[0] <= 2 * 5 + 1
    assert sum(len(x) for x in out) == frames - 1
    assert threading.active_count() < 50


def test_rows_with_a_result_are_not_asked_again(spark):
    import pandas as pd
    asked = []

    class Partial:
        name = "partial"

        def predict(self, pdf):
            asked.append(list(pdf["item_id"]))
            if len(pdf) > 1:
                raise I.PartialResults({0: "first", 2: ("third", "why")})
            if pdf["item_id"].iloc[0] == 11:
                raise ValueError("bad")
            return ["later"]
    got = I._run_batch(Partial(), pd.DataFrame({"item_id": [10, 11, 12, 13]}))
    assert asked == [[10, 11, 12, 13], [11], [13]]
    assert list(got["response"])[::2] == ["first", "third"] and got["error_type"][1] == "ValueError" and got["response"][3] == "later"


def test_report_names_micro_average_for_predictions_outside_the_schema(spark):
    from labelforge.functions.constants import LABEL_SCHEMA as S
    base = [("m", S[0], S[0], 2), ("m", S[1], S[0], 1)]
    for rows, want in ((base, "accuracy"), (base + [("m", S[1], "Elsewhere", 1)], "micro avg"),
                       (base + [("m", "Elsewhere", S[1], 1)], "micro avg")):
        df = spark.createDataFrame(rows, "model string, true_label string, pred_label string, n long")
        names = {r["row_name"]: r["row_ord"] for r in E.class_report(df).collect()}
        assert want in names and names[want] == len(S) and len({*names.values()}) == len(names)


def test_a_cluster_without_a_shared_folder_is_an_error():
    from labelforge import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()
    with pytest.raises(ValueError):
        session.checkpoint_dir(Session())


def test_parsers_set_what_they_need(spark):
    from labelforge.operators import parsing as Rp
    key = "spark.sql.variant.allowDuplicateKeys"
    spark.conf.set(key, "false")
    df = spark.createDataFrame([('{"label": "a", "label": "Insurance"}',)], "response string")
    assert Rp.parse_strict(df).first()["label"] == "Insurance" and spark.conf.get(key) == "true"
