"""Sources and sinks: driver tables, fixture adapters, JSONL and Parquet."""
