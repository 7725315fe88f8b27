"""Empty inputs give empty (or zero) results with the full output schema."""

from labelforge.operators import metrics as E
from labelforge.operators import parsing as Rp
from labelforge.operators import predict as I
from labelforge.operators import prompts as T
from labelforge.operators import ranking
from labelforge.operators import records as Fr
from labelforge.operators import sampling as P


def test_empty_row_operators(spark):
    resp = spark.createDataFrame([], "item_id long, model string, response string")
    d = Rp.parse_diagnostics(resp)
    assert d.count() == 0 and {"pred_label", "ok", "error_code"} <= set(d.columns)
    assert Rp.parse_simple(resp).count() == 0 and Rp.parse_strict(resp).count() == 0
    items = spark.createDataFrame([], "item_id long, split string, label string")
    assert P.split_exact(items.select("item_id")).count() == 0
    assert ranking.first_k(items, ["item_id"], 10**6, ranking.number_bucket("item_id")).count() == 0
    assert Fr.cap_first_n(items, 5).count() == 0
    assert I.prediction_records(items, resp, ["m"]).count() == 0
    assert E.first_failures(d).count() == 0 and E.both_failed(d, ["a", "b"]).count() == 0
    conv = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert T.loss_span_rows(conv).count() == 0
    assert T.turns_from_rows(conv).count() == 0
