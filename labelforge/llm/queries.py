"""Registered queries of the training-data operators: each applies one operator,
with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, extract, linededup, lloyd, lm, mixing, neardup, packing, pii, quality, ranked, vptree, warc
from .common import table


def op1_extract(spark: SparkSession, d: str) -> DataFrame:
    return extract.extract(table(spark, d, "pages"))


def op2_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.rates(table(spark, d, "documents")).drop("source")


def op3_pii(spark: SparkSession, d: str) -> DataFrame:
    return pii.find(table(spark, d, "documents"))


def op4_nearest(spark: SparkSession, d: str) -> DataFrame:
    """Factor 1: exact search."""
    return vptree.nearest(table(spark, d, "embeddings"), F.col("vec_id") % 20 == 0, k=20, factor=1.0)


def op5_gru(spark: SparkSession, d: str) -> DataFrame:
    return lm.score(table(spark, d, "documents"))


def tokenizer() -> tuple[str, str]:
    """(rank file, pre-token pattern) of the public byte-level vocabulary."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op6_bpe(spark: SparkSession, d: str) -> DataFrame:
    return bpe.digests(table(spark, d, "documents"), *tokenizer())


def op7_warc(spark: SparkSession, d: str) -> DataFrame:
    return warc.round_trip(table(spark, d, "pages")).drop("url")


def op8_unit_dedup(spark: SparkSession, d: str) -> DataFrame:
    return linededup.report(table(spark, d, "documents"))


def op9_near_dup(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, d, "documents"), shingle=3, num=85, den=100)


def op10_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.score(table(spark, d, "documents"))


def op11_lloyd(spark: SparkSession, d: str) -> DataFrame:
    return lloyd.report(table(spark, d, "embeddings"), k=40, dim=64, rounds=5, seed=2)


def op12_fp_tree(spark: SparkSession, d: str) -> DataFrame:
    return ranked.rank(table(spark, d, "documents"), table(spark, d, "benchmark"), k=20)


def op13_best_fit(spark: SparkSession, d: str) -> DataFrame:
    import public_tokenizers
    return packing.pack(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"), size=2048, with_ids=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_extract, op2_mix, op3_pii, op4_nearest, op5_gru, op6_bpe, op7_warc, op8_unit_dedup,
                            op9_near_dup, op10_quality, op11_lloyd, op12_fp_tree, op13_best_fit)}
