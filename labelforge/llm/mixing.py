"""Mixing sources to target weights by entropy balancing.

Sizes are words.  Sources, in code point order with null last, weigh 3, 1, 2
and so on; they share ``SHARE`` times all words, no source above ``CEILING``
times its own, the excess reshared by weight.

Inside a source the documents' rates r minimise  sum r log r - r  (distance
from one copy each) under the token constraint  sum r * size = target  and
0 <= r <= CEILING.  The convex dual gives exponentially tilted rates
r = min(CEILING, exp(lambda * size / mean size)), one multiplier per source,
found by damped Newton steps inside a bracket.  Gradient and curvature are sums
over (source, size) counts -- sufficient statistics -- so an iteration reads a
table of distinct sizes, never the documents.

Rates become whole copies floor(r + u + shift), u a hash of the document in
[0, 1).  The shift of a source is where its taken words reach the target, read
off histograms of the values at which documents gain a copy: ``BINS`` bins,
then ``BINS`` bins inside the one that holds the target.

Defined cases: null or empty text has size 0, rate 0 and nothing taken; an
empty table gives an empty result; a source without words has target 0;
documents with equal id and text round alike; reruns agree to the last bit
however the rows are partitioned, as all sums are of integers or decimals;
other columns are ignored by ``rates`` and kept by ``mix``.

Scale: documents are read for sizes, twice for histograms (written narrow
table) and once for the result; a hot source is pre-aggregated in every such
step.  The per-source state (one row per source) is joined, by broadcast when
Spark finds its written size small; then no text is shuffled.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import as_bytes, map_arrow, pieces, stage

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CEILING = 2
BINS = 4096
STEPS = 40           # most Newton steps; each halves the bracket at least
TOLERANCE = 1e-9     # of a source's target
_WORD = r"[^\x20\x09-\x0D]+"


def _exact_sum(x: Column) -> Column:
    """Sum of doubles that does not depend on the order of the rows: every term is
    a decimal of nine places, and decimals add exactly."""
    return F.sum(x.cast("decimal(38,9)")).cast("double")


def _sizes(batches):
    for whole in batches:
        for batch in pieces(whole, "text"):
            size = [len(t.split()) for t in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), batch.column("u"),
                                              pa.array(size, pa.int64())], ["doc_id", "source", "u", "size"])


def _unit(seed: int) -> Column:
    """A hash of id and text in [0, 1) with 2^-40 steps."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 24) / F.lit(float(1 << 40))


def measured(docs: DataFrame, seed: int = 1) -> DataFrame:
    """(doc_id, source, u, size), written once; ``size`` counts words."""
    narrow = docs.select("doc_id", "source", "text", _unit(seed).alias("u"))
    kind = dict(narrow.dtypes)["doc_id"]
    return stage(map_arrow(narrow, _sizes, f"doc_id {kind}, source string, u double, size long"), "sizes")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, ceiling: int = CEILING) -> DataFrame:
    """(source, source_size, longest, n, target) per source.

    The rank of a source needs one order over the source table: one row per
    source, ranged over tasks, offsets of one row per task."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    ordered = stage(per.orderBy(F.col("source").asc_nulls_last())
                    .select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "sources")
    counts = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("k"))
    before = counts.select("part", F.coalesce(F.sum("k").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    rank = F.col("before") + F.col("at") - F.shiftleft(F.col("part").cast("long"), 33)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    now = stage(ordered.join(before, "part").select("source", "source_size", "n", weight.alias("w")), "weights")

    total = now.agg(F.sum("source_size")).first()[0] or 0
    full = total * share
    bound = F.col("source_size") * float(ceiling)
    level = None                 # words per unit of weight of the sources below the ceiling
    while total:
        capped = F.lit(False) if level is None else F.col("w") * F.lit(level) > bound
        row = now.agg(_exact_sum(F.when(capped, bound).otherwise(0.0)).alias("c"),
                      _exact_sum(F.when(capped, 0.0).otherwise(F.col("w"))).alias("w")).first()
        fresh = (full - row["c"]) / row["w"] if row["w"] else 0.0
        if level is not None and fresh <= level:
            break
        level = fresh
    return now.withColumn("target", F.least(F.col("w") * F.lit(float(level or 0.0)), bound)).drop("w")


def balanced(sizes: DataFrame, goals: DataFrame, ceiling: int = CEILING) -> DataFrame:
    """``goals`` with the multiplier ``tilt`` of each source (null: all at the
    ceiling): Newton on the dual, kept inside a bracket that shrinks every step."""
    stats = stage(sizes.filter("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("k")), "size-counts")
    mean = F.col("source_size") / F.greatest(F.col("n"), F.lit(1))
    state = stage(goals.withColumn("mean", mean).withColumn("lo", F.lit(-700.0)).withColumn("hi", F.lit(700.0))
                  .withColumn("tilt", F.lit(0.0)).withColumn("done", (F.col("source_size") == 0) |
                  (F.col("target") >= F.col("source_size") * ceiling)), "dual")
    for _ in range(STEPS):
        joined = stats.alias("x").join(state.filter("not done").alias("s"), F.col("x.source").eqNullSafe(F.col("s.source")))
        z = F.col("size") / F.col("mean")
        rate = F.least(F.lit(float(ceiling)), F.exp(F.least(F.col("tilt") * z, F.lit(50.0))))
        words = F.col("k") * F.col("size")
        sums = joined.groupBy(F.col("s.source").alias("gs")).agg(
            _exact_sum(words * rate).alias("taken"),
            _exact_sum(F.when(rate < ceiling, words * rate * z).otherwise(0.0)).alias("slope"))
        low = F.col("taken") < F.col("target")
        lo, hi = F.when(low, F.col("tilt")).otherwise(F.col("lo")), F.when(low, F.col("hi")).otherwise(F.col("tilt"))
        newton = F.col("tilt") + (F.col("target") - F.col("taken")) / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > lo) & (newton < hi)
        done = F.col("done") | F.coalesce(F.abs(F.col("taken") - F.col("target")) <= TOLERANCE * F.col("target") + 1e-6,
                                          F.lit(False))
        state = stage(state.join(sums, F.col("source").eqNullSafe(F.col("gs")), "left").select(
            "source", "source_size", "n", "target", "mean",
            F.when(done, F.col("lo")).otherwise(lo).alias("lo"), F.when(done, F.col("hi")).otherwise(hi).alias("hi"),
            F.when(done, F.col("tilt")).when(inside, newton).otherwise((lo + hi) / 2).alias("tilt"), done.alias("done")), "dual")
        if state.filter("not done").limit(1).count() == 0:
            break
    at_ceiling = (F.col("target") >= F.col("source_size") * ceiling) & (F.col("source_size") > 0)
    return stage(state.select("source", "source_size", "target", "mean",
                              F.when(~at_ceiling, F.col("tilt")).alias("tilt")), "tilts")


def _rate(ceiling: int) -> Column:
    tilted = F.least(F.lit(float(ceiling)), F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(50.0))))
    return F.when(F.col("size") == 0, 0.0).otherwise(F.coalesce(tilted, F.lit(float(ceiling))))


def _thresholds(rated: DataFrame, ceiling: int) -> DataFrame:
    """Each gain of a copy: a document takes copy k once the shift reaches ``e``."""
    gains = F.transform(F.sequence(F.lit(1), F.lit(ceiling)), lambda k: k - F.col("rate") - F.col("u"))
    return rated.filter("size > 0").select("source", "size", F.explode(gains).alias("e"))


def _reach(gains: DataFrame, goals: DataFrame, bins: int, low: Column, high: Column) -> DataFrame:
    """``goals`` narrowed to the bin of [lo, hi) in which the taken words reach the
    target: the histogram has at most ``bins`` rows per source."""
    width = (high - low) / bins
    g = gains.alias("g").join(goals.alias("t"), F.col("g.source").eqNullSafe(F.col("t.source")))
    hist = (g.filter((F.col("e") >= low) & (F.col("e") < high))
            .groupBy(F.col("t.source").alias("source"), F.floor((F.col("e") - low) / width).alias("bin"))
            .agg(F.sum("size").alias("words")))
    run = hist.withColumn("upto", F.sum("words").over(
        Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)))
    near = run.alias("h").join(goals.alias("t"), F.col("h.source").eqNullSafe(F.col("t.source"))).filter(
        F.col("base") + F.col("upto") >= F.col("target")).groupBy(F.col("t.source").alias("hs")).agg(
        F.min(F.struct("bin", "upto", "words")).alias("m"))
    out = goals.join(near, F.col("source").eqNullSafe(F.col("hs")), "left").select(
        "source", "target", "base", "lo", "hi", F.col("m.bin").alias("bin"), (F.col("m.upto") - F.col("m.words")).alias("below"),
        F.col("m.words").alias("words"))
    at = F.col("lo") + F.col("bin") * ((F.col("hi") - F.col("lo")) / bins)
    return out.select("source", "target", (F.col("base") + F.coalesce("below", F.lit(0))).alias("base"),
                      F.coalesce(at, F.col("hi")).alias("lo"),
                      F.coalesce(at + (F.col("hi") - F.col("lo")) / bins, F.col("hi")).alias("hi"), "words")


def rates(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, ceiling: int = CEILING, seed: int = 1) -> DataFrame:
    """(doc_id, size, source_size, target, taken, rate, copies, source) per document
    of (doc_id, text, source)."""
    return _mixed(measured(docs, seed), weights, share, ceiling).drop("u")


def _levels(sizes: DataFrame, weights: tuple, share: float, ceiling: int) -> DataFrame:
    """(ts, source_size, target, mean, tilt, shift) per source ``ts``: all that a
    document's copies depend on besides its own size and hash."""
    tilts = balanced(sizes, targets(sizes, weights, share, ceiling), ceiling)
    t = tilts.withColumnRenamed("source", "ts")
    rated = stage(sizes.select("source", "size", "u").join(t, F.col("source").eqNullSafe(F.col("ts")), "left")
                  .select("source", "size", "u", _rate(ceiling).alias("rate")), "rates")
    span = float(ceiling + 1)
    goals = tilts.select("source", "target", F.lit(0.0).alias("base"), F.lit(-span).alias("lo"), F.lit(span).alias("hi"))
    gains = _thresholds(rated, ceiling)
    coarse = stage(_reach(gains, goals, BINS, F.col("lo"), F.col("hi")).drop("words"), "coarse")
    fine = stage(_reach(gains, coarse, BINS, F.col("lo"), F.col("hi")), "fine")
    # the bin that holds the target comes whole or not at all, whichever is nearer
    shift = fine.select(F.col("source").alias("fs"), F.when(
        F.col("words").isNull() | (F.abs(F.col("base") + F.col("words") - F.col("target")) <= F.abs(F.col("target") - F.col("base"))),
        F.col("hi")).otherwise(F.col("lo")).alias("shift"))
    return stage(t.join(shift, F.col("ts").eqNullSafe(F.col("fs")), "left").drop("fs"), "levels")


def _copied(rows: DataFrame, levels: DataFrame, ceiling: int) -> DataFrame:
    """``rows`` (source, size, u, more) with rate, copies and the columns of their source's level."""
    copies = sum(((k - F.col("rate") - F.col("u")) < F.col("shift")).cast("long") for k in range(1, ceiling + 1))
    copies = F.when(F.col("tilt").isNull(), F.lit(ceiling).cast("long")).otherwise(copies)
    return (rows.join(levels, F.col("source").eqNullSafe(F.col("ts")), "left").withColumn("rate", _rate(ceiling))
            .withColumn("copies", F.when(F.col("size") == 0, F.lit(0).cast("long")).otherwise(copies)))


def rates(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, ceiling: int = CEILING, seed: int = 1) -> DataFrame:
    """(doc_id, size, source_size, target, taken, rate, copies, source) per document
    of (doc_id, text, source)."""
    sizes = measured(docs, seed)
    return _copied(sizes, _levels(sizes, weights, share, ceiling), ceiling).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "rate", "copies", "source")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, ceiling: int = CEILING, seed: int = 1) -> DataFrame:
    """The rows of ``docs`` (all columns), each as often as the mix takes it.  A row's copies
    follow from its own words and hash and its source's level, so texts stay where they are."""
    levels = _levels(measured(docs, seed), weights, share, ceiling)
    size = F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       "source", size.alias("size"), _unit(seed).alias("u"))
    return (_copied(rows, levels, ceiling).filter("copies > 0")
            .select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).select("doc.*"))
