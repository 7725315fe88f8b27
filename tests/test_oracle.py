"""Every registered query equals its DuckDB oracle (driver gate, small scale)."""

import pytest

from labelforge.plans.oracle import ORACLE_SQL
from labelforge.plans.queries import QUERIES

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def results(spark):
    from labelforge.plans.check import compare
    return compare(spark, SF_SMALL, verbose=False)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(results, name):
    assert results[name] == "ok", results[name]


def test_entry_runs(spark):
    import importlib.util
    import os
    p = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", p)
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    df = m.entry(spark)
    rows = df.collect()
    assert len(rows) == 76 and set(df.columns) >= {"model", "label", "precision", "recall", "f1"}
    assert set(QUERIES) <= set(m.queries()) and set(ORACLE_SQL) <= set(m.oracle_sql())
