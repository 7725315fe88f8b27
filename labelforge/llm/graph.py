"""Connected components of a distributed edge table (alternating stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free checksum of an edge table: two scalars."""
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b") % 1_000_003).alias("h")).first()
    return row["n"], row["h"]


def _star(neighbours: DataFrame, keep: str, self_edge: bool) -> DataFrame:
    """Link each neighbour ``b`` of ``a`` to the smallest of a's neighbours and
    itself.  The minima are written first, so that the join has a plain shuffle
    on both sides and adaptive execution can split the hub of a large star."""
    least = stage(neighbours.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "star-minima")
    linked = neighbours.filter(keep).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if self_edge:
        linked = linked.unionByName(least.select("a", F.col("m").alias("b")))
    return stage(linked.filter("a <> b").distinct(), "star-edges")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): for every node of ``edges`` (columns a, b of long) the
    smallest node it is connected with.  Alternates large and small stars until
    the edge table rests, O(log^2 n) rounds; every round is written down."""
    now = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .filter("a <> b").distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both, "b > a", False)
        now = _star(large, "true", True)
        last, mark = mark, _mark(now)
        if last == mark:
            break
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
