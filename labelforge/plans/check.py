"""Local Spark-vs-DuckDB comparison, shaped like the driver's correctness gate:
row count, column names, and an order-insensitive multiset of normalised rows."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

from .oracle import ORACLE_SQL
from .queries import QUERIES
from ..sources.tables import TABLES


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN"}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(repr(_norm(r[i])) for i in order) for r in records]
    return sorted(out)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict:
    con = duck(sf_dir)
    res = {}
    for name in names or sorted(QUERIES):
        if name not in ORACLE_SQL:
            res[name] = "no-oracle"
            continue
        t0 = time.time()
        try:
            sdf = QUERIES[name](spark, sf_dir)
            s_cols = sdf.columns
            s_rows = [tuple(r) for r in sdf.collect()]
            t1 = time.time()
            rel = con.sql(ORACLE_SQL[name])
            d_cols = list(rel.columns)
            d_types = {c: str(t) for c, t in zip(d_cols, rel.types)}
            d_rows = rel.fetchall()
            s_types = dict(sdf.dtypes)
        except Exception as e:  # noqa: BLE001
            res[name] = f"error: {type(e).__name__}: {str(e)[:400]}"
            if verbose:
                print(f"{name:24s} ERROR {res[name]}", flush=True)
            continue
        bad_types = [(c, s_types[c], d_types.get(c)) for c in s_cols
                     if SPARK_TO_DUCK.get(s_types[c], s_types[c]) != d_types.get(c)]
        if sorted(s_cols) != sorted(d_cols):
            res[name] = f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
        elif bad_types:
            res[name] = f"types differ: {bad_types}"
        elif len(s_rows) != len(d_rows):
            res[name] = f"rows differ: spark={len(s_rows)} duck={len(d_rows)}"
        else:
            a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
            if a == b:
                res[name] = "ok"
            else:
                diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
                res[name] = f"values differ ({sum(1 for x, y in zip(a, b) if x != y)} rows), e.g. {diff}"
        if verbose:
            print(f"{name:24s} {res[name][:700]}  ({t1 - t0:.1f}s spark)", flush=True)
    return res


if __name__ == "__main__":
    from ..session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    r = compare(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in r.items() if v != "ok"}
    print(f"{len(r) - len(bad)}/{len(r)} ok; not ok: {sorted(bad)}")
