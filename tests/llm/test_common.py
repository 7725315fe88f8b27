"""Shared helpers."""

import os

import pyarrow as pa

from labelforge.llm import common


def test_stages_are_written_once_and_dropped(spark):
    df = common.stage(spark.range(5), "numbers")
    folder = df.inputFiles()[0].removeprefix("file://").rsplit("/", 2)[0]
    assert sorted(r[0] for r in df.collect()) == [0, 1, 2, 3, 4] and os.path.isdir(folder)
    common.drop_stages(spark)
    assert not os.path.exists(folder)


def test_pieces_hold_every_row_once():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n if n else None for n in (0, 5, 100, 1, 0, 7)])], ["text"])
    for limit in (1, 6, 1000):
        parts = list(common.pieces(batch, "text", limit))
        assert pa.Table.from_batches(parts).column("text").to_pylist() == batch.column("text").to_pylist()
        assert all(p.num_rows for p in parts)
    assert list(common.pieces(batch.slice(0, 0), "text")) == []
