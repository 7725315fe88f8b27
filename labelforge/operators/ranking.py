"""Exact ordered selection without a single-task sort of the data.

``cutoffs`` finds, per group, the order key of the k-th row.  The narrow keys are
written once; then a group's range of keys is cut into cells, rows are counted
per cell, and the smallest and largest key of the cell that holds the k-th row are the
next round's range.  Rounds end when that range holds few enough keys to rank in a
task, whatever the distribution: an outlying key costs a round, not a large task.
Selecting rows is then a comparison with the cut-off, map-only, for every k
alike: no full row is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

RANKED = 65_536     # keys that one task ranks at most
CELLS = 1_024       # cells of a range in one round
HEAD = 1_000        # up to this many first rows of a whole table, a top-k of narrow keys gives the cut-off
_ROW_BITS = 33      # of monotonically_increasing_id: the row's place in its partition


def hex_bucket(key: str) -> Callable[[list[str]], list[Column]]:
    """Numbers that narrow an order starting with a hex digest column: its first 60
    bits, then the order's other columns (numbers)."""
    return lambda order: [F.conv(F.substring(key, 1, 15), 16, 10).cast("long"), *(F.col(c) for c in order if c != key)]


def number_bucket(key: str) -> Callable[[list[str]], list[Column]]:
    """Numbers that narrow an order of number columns: these columns."""
    return lambda order: [F.col(c) for c in order]


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def _span(x: Column, low: Column) -> Column:
    """x - low as a double; never decreasing in x, exact for whole numbers that are near."""
    return F.coalesce(F.try_subtract(x, low).cast("double"), x.cast("double") - low.cast("double"))


def _within(i: int) -> Column:
    p, low, high = F.col(f"_p{i}"), F.col(f"_lo{i}"), F.col(f"_hi{i}")
    return p.eqNullSafe(low) | p.eqNullSafe(high) | ((low.isNull() | (p > low)) & (p < high))


def cutoffs(df: DataFrame, order: list[str], bucket: Callable[[list[str]], list[Column]], need: Callable[[Column], Column],
            by: list[str] | None = None) -> DataFrame:
    """(by..., _cut): the order key (struct) of row ``need(total)`` of each group;
    no row for groups that have fewer.  ``order`` must be a total order; nulls come first."""
    by = by or []
    places = bucket(order)
    n_places = len(places)
    keys = materialize(df.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)], F.struct(*order).alias("_key"),
                                 *[c.alias(f"_p{i}") for i, c in enumerate(places)]))
    groups = [f"_g{i}" for i in range(len(by))]
    ends = [e for i in range(n_places) for e in (
        F.when(F.max(F.col(f"_p{i}").isNull()), None).otherwise(F.min(f"_p{i}")).alias(f"_lo{i}"), F.max(f"_p{i}").alias(f"_hi{i}"))]
    state_columns = [*groups, "_n", "_need", *[f"_{e}{i}" for i in range(n_places) for e in ("lo", "hi")]]
    total = keys.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"), *ends)
    state = materialize(total.withColumn("_need", need(F.col("_n")).cast("long")).filter(
        (F.col("_need") >= 1) & (F.col("_need") <= F.col("_n"))).select(*state_columns))

    def inside(ranges: DataFrame) -> DataFrame:
        """Keys in their group's ranges, with the group's state."""
        renamed = ranges.select(*[F.col(g).alias(f"_s{g}") for g in groups], *state_columns[len(groups):])
        same = _all([F.col(g).eqNullSafe(F.col(f"_s{g}")) for g in groups])
        return keys.join(renamed, same & _all([_within(i) for i in range(n_places)]))

    group = Window.partitionBy(*(groups or [F.lit(0)]))
    for i in range(n_places):
        wide = (F.col("_n") > RANKED) & ~F.col(f"_lo{i}").eqNullSafe(F.col(f"_hi{i}"))
        while not state.filter(wide).isEmpty():
            p, low, high = F.col(f"_p{i}"), F.col(f"_lo{i}"), F.col(f"_hi{i}")
            # nulls have a cell of their own before the others; the next range starts above them
            cell = F.when(low.isNotNull(), F.floor(_span(p, low) / (_span(high, low) + 1) * CELLS)).otherwise(
                F.when(p.isNull(), -1).otherwise(0))
            counts = inside(state.filter(wide)).groupBy(*groups, "_need", cell.alias("_cell")).agg(
                F.count(F.lit(1)).alias("_n"), *ends)
            # at most CELLS + 1 rows per group
            upto = F.sum("_n").over(group.orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0))
            hit = counts.withColumn("_upto", upto).filter(
                (F.col("_upto") >= F.col("_need")) & (F.col("_upto") - F.col("_n") < F.col("_need"))).withColumn(
                "_need", F.col("_need") - F.col("_upto") + F.col("_n"))
            state = materialize(state.filter(~wide).select(*state_columns).unionByName(hit.select(*state_columns)))
    few = inside(state.filter(F.col("_n") <= RANKED)).withColumn("_rn", F.row_number().over(group.orderBy("_key")))
    cut = few.filter(F.col("_rn") == F.col("_need")).select(*groups, "_key")
    # more rows than that are left only where all of them have one key
    alike = inside(state.filter(F.col("_n") > RANKED)).groupBy(*groups).agg(F.max("_key").alias("_key"))
    out = cut.unionByName(alike.filter(F.col("_key").isNotNull()).select(*groups, "_key"))
    return out.select(*[F.col(g).alias(c) for g, c in zip(groups, by)], F.col("_key").alias("_cut"))


def first_k(df: DataFrame, order: list[str], k: int | None, bucket: Callable[[list[str]], list[Column]],
            by: list[str] | None = None) -> DataFrame:
    """First ``k`` rows of ``df`` (of each ``by`` group) under ``order``; ``None`` keeps all."""
    if k is None:
        return df
    if k <= 0:
        return df.filter(F.lit(False))
    key = F.struct(*order)
    if not by:
        if k <= HEAD:
            cut = df.select(key.alias("_key")).orderBy("_key").limit(int(k)).agg(F.max("_key").alias("_cut"))
        else:
            cut = cutoffs(df, order, bucket, lambda total: F.lit(int(k)))
        return df.filter(F.coalesce(key <= cut.select("_cut").scalar(), F.lit(True)))
    cut = cutoffs(df, order, bucket, lambda total: F.lit(int(k)), by)
    cut = cut.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)], "_cut")
    same = _all([F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(by)])
    joined = df.join(cut, same, "left").filter(F.col("_cut").isNull() | (key <= F.col("_cut")))
    return joined.select(*df.columns)


def first_fraction(df: DataFrame, order: list[str], fraction: float, bucket: Callable[[list[str]], list[Column]]) -> DataFrame:
    """``df`` plus boolean ``_head``: the first ``ceil(fraction * n)`` rows under ``order``."""
    if fraction <= 0:
        return df.withColumn("_head", F.lit(False))
    cut = cutoffs(df, order, bucket, lambda total: F.ceil(total * F.lit(float(fraction))))
    return df.withColumn("_head", F.coalesce(F.struct(*order) <= cut.select("_cut").scalar(), F.lit(False)))


def positions(df: DataFrame, order: list[str], num_partitions: int | None = None) -> DataFrame:
    """``df`` plus ``position``: the dense 0-based place of each row under ``order`` (a
    total order).

    Rows are range-partitioned and sorted; a row's place is the number of rows in the
    partitions before its own, one number per partition, plus its place inside."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    placed = materialize(ranged.select("*", F.shiftright(at, _ROW_BITS).cast("int").alias("_pid"),
                                       at.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_at")))
    before, offsets = 0, []
    for pid, rows in sorted(placed.groupBy("_pid").count().collect()):
        offsets.append((pid, before))
        before += rows
    starts = spark.createDataFrame(offsets, "_pid int, _off long")
    return placed.join(starts, "_pid").select(*[F.col(c) for c in df.columns], (F.col("_off") + F.col("_at")).alias("position"))


def segmented_offsets(df: DataFrame, key: str, order: str, value: str, head: list[str] | None = None,
                      num_partitions: int | None = None) -> DataFrame:
    """``df`` plus ``_before``: sum of ``value`` over earlier rows (by ``order``)
    of the same ``key`` -- an exclusive running sum per key -- and ``_first``, the
    ``head`` columns of the key's first row.

    A window ``partitionBy(key)`` would send a whole key to one task; here the
    rows are range-partitioned on (key, order) as they come, so a hot key spreads
    over many tasks.  Per (partition, key) totals -- at most partitions + keys
    rows -- get running offsets, which are joined back on both columns; each task
    then adds its local running sum.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ranged = df.repartitionByRange(n, F.col(key), F.col(order)).sortWithinPartitions(key, order)
    pos = materialize(ranged.select("*", F.spark_partition_id().alias("_pid")))
    own = F.struct(F.col(order).alias("_order"), *(head or []))
    pieces = pos.groupBy("_pid", key).agg(F.sum(value).alias("_piece"), F.min(own).alias("_own"))
    w = Window.partitionBy(key).orderBy("_pid")
    offs = pieces.select("_pid", key, F.coalesce(F.sum("_piece").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                                                 F.lit(0)).alias("_off"),
                         F.first("_own").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_first"))
    # Local running sum inside each (partition, key) piece; partitions already
    # hold their rows sorted, and the window keys match the range boundaries.
    wl = Window.partitionBy("_pid", key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = pos.select("*", F.coalesce(F.sum(value).over(wl), F.lit(0)).alias("_loc"))
    out = local.join(offs, ["_pid", key])
    return out.select(*[F.col(c) for c in df.columns], (F.col("_off") + F.col("_loc")).alias("_before"), "_first")
