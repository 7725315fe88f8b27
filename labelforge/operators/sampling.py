"""Seeded shuffles, evaluation samples and train/validation splits.

Order is a per-row hash, ``md5(seed || ':' || item_id)``: the same seed gives
the same sample under any partitioning, and filter and shuffle commute.
"""

from __future__ import annotations

import random
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import HEAD, first_fraction, first_k, hex_bucket, number_bucket, positions
from ..session import materialize
from .records import drop_none_exact, drop_none_loose, drop_none_observed


def shuffle_key(seed: int, item_col: str = "item_id") -> Column:
    """Hex md5 of ``seed:item_id``; sort on (key, item_id)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(item_col).cast("string")))


def draw_seed() -> int:
    """Seed for an unseeded shuffle; record it with the output."""
    return random.SystemRandom().randrange(0, 2**31)


def with_shuffle_key(df: DataFrame, seed: int | None) -> DataFrame:
    seed = draw_seed() if seed is None else seed
    return df.withColumn("shuffle_key", shuffle_key(seed)).withColumn("seed", F.lit(seed).cast("long"))


def shuffled(df: DataFrame, seed: int | None, num_partitions: int | None = None) -> DataFrame:
    """``df`` with shuffle_key, seed and ``position``, the row's dense 0-based place in
    the shuffled order; write it sorted by ``position`` to have the order in files."""
    return positions(with_shuffle_key(df, seed), ["shuffle_key", "item_id"], num_partitions)


def sample_eval(df: DataFrame, num_samples: int | None = 50, exclude_none: bool = True,
                randomize: bool = False, seed: int | None = None) -> DataFrame:
    """P2 (pipeline order): shuffle -> exact NONE filter -> head N.

    With ``randomize=False`` the head follows ``item_id``.  ``num_samples``
    of 0/None keeps all rows.
    """
    x = drop_none_exact(df) if exclude_none else df
    if randomize:
        return first_k(with_shuffle_key(x, seed), ["shuffle_key", "item_id"], num_samples or None, hex_bucket("shuffle_key"))
    return first_k(x, ["item_id"], num_samples or None, number_bucket("item_id"))


def sample_eval_counted(df: DataFrame, num_samples: int = 50, randomize: bool = False, seed: int | None = None,
                        loose: bool = False) -> tuple[DataFrame, dict]:
    """P2 with its counts: the sample, written once, and {requested, total, excluded,
    available, sampled}, which come from the job that wrote it: the input is read once."""
    kept, seen = drop_none_observed(df, loose)
    order = ["shuffle_key", "item_id"] if randomize else ["item_id"]
    x = with_shuffle_key(kept, seed) if randomize else kept
    if num_samples and num_samples <= HEAD:
        out = materialize(x.orderBy(*order).limit(num_samples))
    else:
        whole = materialize(x)
        out = first_k(whole, order, num_samples or None, hex_bucket("shuffle_key") if randomize else number_bucket("item_id"))
    counts = seen.get
    available = counts["total"] - counts["excluded"]
    return out, {"requested": num_samples, "total": counts["total"], "excluded": counts["excluded"], "available": available,
                 "sampled": min(num_samples, available) if num_samples else available}


def sample_eval_loose(df: DataFrame, num_samples: int = 5, seed: int | None = 42) -> DataFrame:
    """P3 (notebook order): loose NONE filter -> shuffle -> min(N, size)."""
    x = with_shuffle_key(drop_none_loose(df), seed)
    return first_k(x, ["shuffle_key", "item_id"], num_samples, hex_bucket("shuffle_key"))


def split_hash(df: DataFrame, test_size: float = 0.1, seed: int = 42) -> DataFrame:
    """P4 default: validation when the key (as a fraction of the key space) falls
    below ``test_size``; 0 gives none, 1 gives all.  Map-only; size is approximate."""
    share = Fraction(repr(float(test_size)))
    below = F.lit(share >= 1)
    if 0 < share < 1:
        below = shuffle_key(seed) < F.lit(format(int(share * 16**32), "032x"))
    return df.withColumn("role", F.when(below, "validation").otherwise("train"))


def split_exact(df: DataFrame, test_size: float = 0.1, seed: int = 42) -> DataFrame:
    """P4 exact: the first ``ceil(test_size * n)`` rows by key are validation."""
    x = df.withColumn("_sort", shuffle_key(seed))
    r = first_fraction(x, ["_sort", "item_id"], test_size, hex_bucket("_sort"))
    return r.select(*[F.col(c) for c in df.columns],
                    F.when(F.col("_head"), "validation").otherwise("train").alias("role"))


WANTED_SPLITS = ["train", "validation", "val", "test"]


def split_names(df: DataFrame) -> list[str]:
    """Of the split names those that resolution asks for, the split of the first item
    before them: one aggregate, however many splits there are."""
    first = F.min(F.struct(F.col("item_id").isNull().alias("n"), "item_id", "split"))
    r = df.agg(first["split"].alias("first"), F.count(F.lit(1)).alias("n"),
               *[F.max(F.col("split").eqNullSafe(w)).alias(w) for w in WANTED_SPLITS]).first()
    if not r["n"]:
        return []
    return [r["first"], *[w for w in WANTED_SPLITS if r[w] and w != r["first"]]]


def resolve_splits(df: DataFrame, test_size: float = 0.1, seed: int = 42,
                   names: list[str] | None = None) -> DataFrame:
    """P5: (train, validation) roles.

    ``train`` + the first of ``validation``, ``val``, ``test``; with only
    ``train``, carve validation from it; without ``train``, carve from the
    first split in item order.  Rows of other splits are dropped.  A table
    without a ``split`` column is one dataset: validation is carved from it.
    """
    if "split" not in df.columns:
        return split_hash(df, test_size, seed)
    names = split_names(df) if names is None else names
    if "train" in names:
        val = next((v for v in ["validation", "val", "test"] if v in names), None)
        if val is not None:
            x = df.filter(F.col("split").isin("train", val))
            return x.withColumn("role", F.when(F.col("split") == "train", "train").otherwise("validation"))
        base = "train"
    elif names:
        base = names[0]
    else:
        return df.withColumn("role", F.lit(None).cast("string")).limit(0)
    return split_hash(df.filter(F.col("split") == base), test_size, seed)


def base_split(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Rows of ``test`` if present, else of the first split name."""
    names = split_names(df) if names is None else names
    chosen = "test" if "test" in names else (names[0] if names else None)
    return df.filter(F.col("split") == F.lit(chosen))
