"""Queries that SQL can express equal their DuckDB SQL."""

import pytest

from labelforge.llm.oracle import ORACLE_SQL
from labelforge.llm.queries import QUERIES
from labelforge.plans import check

from ..conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, monkeypatch, name):
    monkeypatch.setattr(check, "QUERIES", QUERIES)
    monkeypatch.setattr(check, "ORACLE_SQL", ORACLE_SQL)
    assert check.compare(spark, SF_SMALL, [name], verbose=False)[name] == "ok"
