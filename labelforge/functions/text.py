"""String helpers as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import PY_WHITESPACE


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Python ``str.strip()``: trims the full Unicode whitespace set, null stays null."""
    return F.btrim(col_(c), F.lit(PY_WHITESPACE))


def strip_or_empty(c) -> Column:
    """``(x or "").strip()``."""
    return py_strip(F.coalesce(col_(c), F.lit("")))


def json_escape(c) -> Column:
    """JSON string literal (with quotes) for a string column; null -> ``null``.

    ``to_json(array(x))`` minus its brackets: UTF-8 kept raw, same escapes as
    a standard serializer (control characters as \\uXXXX).
    """
    j = F.to_json(F.array(col_(c)))
    return F.substring(j, F.lit(2), F.length(j) - 2)


def truncate_text(c, limit: int = 500, suffix: str = "...") -> Column:
    """First ``limit`` code points + suffix when longer; null -> ''."""
    s = F.coalesce(col_(c), F.lit(""))
    return F.when(F.length(s) > limit, F.concat(F.substring(s, 1, limit), F.lit(suffix))).otherwise(s)


def plan_barrier(c) -> Column:
    """``c`` unchanged, marked non-deterministic.

    Staged parsers build each step on the previous step's column.  A later
    filter on a parse result would be pushed down through every stage and
    inline all of them into one expression, multiplying shared sub-trees.
    Routing the final stage through a non-deterministic (but constant) guard
    keeps filters above it.  Cost: one comparison per row.
    """
    return F.when(F.spark_partition_id() < 0, F.lit(None)).otherwise(col_(c))


def _sql_lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def str_array(values: list[str]) -> Column:
    """Literal ``array<string>`` built in one expression (one JVM call)."""
    return F.expr("array(" + ", ".join(_sql_lit(v) for v in values) + ")")


def str_map_to_int(values: list[str]) -> Column:
    """Literal ``map<string,int>`` value -> 0-based position."""
    return F.expr("map(" + ", ".join(f"{_sql_lit(v)}, {i}" for i, v in enumerate(values)) + ")")


def in_list(c, values: list[str]) -> Column:
    """``c IN (values)`` as one expression; null stays null."""
    return F.array_contains(str_array(values), col_(c)) if values else F.lit(False)
