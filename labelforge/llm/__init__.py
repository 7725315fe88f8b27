"""Training-data operators: extraction, mixing, PII, search, LM scoring, BPE,
WARC, line dedup, near-dedup and quality rules.

Nothing outside this subpackage imports it.  Operators take and return
DataFrames; Python runs only inside Arrow batches that Spark partitions.
"""
