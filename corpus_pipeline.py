"""The corpus pipeline: quality rules, near-dedup, PII, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's result as Parquet in the shared folder and rereads it as the next
one's docs.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from labelforge.llm import bpe, mixing, neardup, pii, quality
from labelforge.llm.common import stage, table
from labelforge.llm.queries import tokenizer


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base and divergence rules."""
    return quality.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8)."""
    return neardup.keep_one(docs, shingle=5, num=80, den=100)


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by [KIND]; ``n_chars`` counts the new text."""
    return pii.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids instead of texts: doc_id, lang, source, n_chars, n_tokens, ids."""
    return bpe.encode(docs, *tokenizer())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("pii_redaction", pii_redaction),
    ("source_mix", source_mix),
    ("bpe_tokens", bpe_tokens),
]

# Divergence limits, verified near links, the tagger and BPE are no SQL; the
# stages are tested against brute-force versions in tests/llm/.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
