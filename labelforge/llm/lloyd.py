"""Centroid clustering: Lloyd's rounds over vectors sharded by dimension.

Vectors are cut into chunks of rows and every chunk into blocks of columns: one
record holds one block of one chunk.  In a round each block's task computes, from
its own slice of the centroids, exact partial squared distances of its rows to all
centroids; ``reduceByKey`` on the chunk adds the blocks' distances, and their
argmin (the smaller number wins ties) is the assignment.  The assignment goes
back to the chunk's blocks, where each shard of columns sums its own slice per
centroid and updates it: the exact floor of sum / count.  Centroids without vectors
stay.  Only the slices, together k rows of the vectors' length, pass the driver.

All sums are of integers.  They are 64-bit while the sizes of the components
allow it and Python integers beyond, so nothing is rounded.

Defined cases: vectors that are null, of another length, or hold a null or non-finite
component take no part; fewer vectors than ``k`` give as many centroids as vectors; rows
that repeat an id are separate vectors; a null id counts as empty text where ids are
hashed; a distance or inertia beyond 64 bits is null; empty tables give no rows; other
columns are ignored.

Scale: blocks are written once and dealt by (shard, chunk) once, in shuffle files that
all rounds read.  A round moves k sums per row and block (added up per chunk) and
one assignment per row and block; no key holds more than one chunk of ``CHUNK`` rows.
A round's plan depends on the round before through the centroids' numbers only.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import map_arrow, stage

CHUNK = 4_096
SHARDS = 4
_SAFE = 2**62       # sums below this stay in 64 bits


def kept(vectors: DataFrame, dim: int) -> DataFrame:
    """(vec_id, embedding) of rows whose ``embedding`` has ``dim`` components, all finite."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    e = F.col("embedding")
    return vectors.filter(F.coalesce((F.size(e) == dim) & finite, F.lit(False))).select("vec_id", e.cast("array<double>").alias("embedding"))


def first_by_hash(vectors: DataFrame, k: int, seed: int) -> list[list[float]]:
    """The ``k`` vectors with the smallest SHA-256 of "seed:vec_id", in that order; of
    rows with one id the smaller vectors come first."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    chosen = vectors.select(key.alias("key"), "embedding").orderBy("key", "embedding").limit(k)
    return [r["embedding"] for r in chosen.collect()]


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles: 64-bit integers where they fit, else Python ones
    (a product beyond the doubles is taken exactly)."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * scale)
    if not scaled.size or np.abs(scaled).max() < 2**52:
        return scaled.astype(np.int64)
    out = np.empty(values.shape, object)
    out.ravel()[:] = [int(y) if math.isfinite(y) else int(x) * scale for x, y in zip(values.ravel().tolist(), scaled.ravel().tolist())]
    return out


def _largest(a: np.ndarray) -> int:
    return max(abs(int(a.min())), abs(int(a.max()))) if a.size else 0


def partial(block: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows x centroids) over the block's columns."""
    reach = _largest(block) + _largest(centroids)
    if reach * reach * max(1, block.shape[1]) >= _SAFE:
        block, centroids = block.astype(object), centroids.astype(object)
    out = np.zeros((len(block), len(centroids)), block.dtype)
    for c in range(block.shape[1]):
        d = block[:, c:c + 1] - centroids[None, :, c]
        out += d * d
    return out


def add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact sum of two arrays of integers."""
    return a + b if _largest(a) + _largest(b) < _SAFE else a.astype(object) + b.astype(object)


def sums(block: np.ndarray, labels: np.ndarray, k: int) -> np.ndarray:
    """Per centroid the exact sum of the block's rows assigned to it (k x columns)."""
    if _largest(block) * max(1, len(block)) >= _SAFE:
        block = block.astype(object)
    out = np.zeros((k, block.shape[1]), block.dtype)
    by = np.argsort(labels, kind="stable")
    edge = np.flatnonzero(np.diff(labels[by], prepend=-1))
    if len(edge):
        out[labels[by][edge]] = np.add.reduceat(block[by], edge, axis=0)
    return out


def _chunks(vectors: DataFrame, dim: int, edges: list[int]) -> DataFrame:
    """(chunk, shard, ids, data): the doubles of one block by row; ids lie with shard 0."""
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                values = np.asarray(batch.column("embedding").flatten(), np.float64).reshape(batch.num_rows, dim)
                own = [values[:, a:b].astype("<f8").tobytes() for a, b in zip(edges, edges[1:])]
                ids = batch.column("vec_id")
                none = [len(ids)] * (len(own) - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * len(own), pa.int64()), pa.array(range(len(own)), pa.int32()),
                     pa.ListArray.from_arrays(pa.array([0, len(ids), *none], pa.int32()), ids), pa.array(own, pa.binary())],
                    ["chunk", "shard", "ids", "data"])
                chunk += 1

    return map_arrow(vectors, run, f"chunk long, shard int, ids array<{kind}>, data binary")


def _assigned(blocks: RDD, slices: list[np.ndarray], parts: int) -> RDD:
    """(chunk, (labels, distances)): blocks' distances added up, smallest taken."""
    def nearest(total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        labels = total.argmin(1)
        return labels.astype(np.int32), total[np.arange(len(total)), labels]

    distances = blocks.map(lambda x: (x[0][1], partial(x[1], slices[x[0][0]])))
    return distances.reduceByKey(add, parts).mapValues(nearest)


def _updated(blocks: RDD, assigned: RDD, slices: list[np.ndarray], parts: int) -> list[np.ndarray]:
    """The next slices: each shard sums its own columns per centroid."""
    shards, k = len(slices), len(slices[0])

    def share(labels: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return sums(block, labels, k), np.bincount(labels, minlength=k)

    def moved(shard: int, total: np.ndarray, n: np.ndarray) -> np.ndarray:
        some = n > 0
        out = slices[shard].astype(object)
        out[some] = total[some].astype(object) // n[some].astype(object)[:, None]
        return out.astype(np.int64) if _largest(out) < _SAFE else out

    back = assigned.flatMap(lambda x: [((s, x[0]), x[1][0]) for s in range(shards)])
    own = blocks.join(back.partitionBy(parts), parts)
    added = own.map(lambda x: (x[0][0], share(x[1][1], x[1][0]))).reduceByKey(
        lambda a, b: (add(a[0], b[0]), a[1] + b[1]), shards)
    new = added.map(lambda x: (x[0], moved(x[0], *x[1]))).collectAsMap()      # k rows in all
    return [new.get(s, old) for s, old in enumerate(slices)]


def lloyd(vectors: DataFrame, start: list[list[float]], dim: int, rounds: int = 5, shards: int = SHARDS,
          scale: int = 256) -> tuple[DataFrame, list[list[int]]]:
    """((vec_id, cluster, distance), centroids) after ``rounds`` rounds from the centroids
    ``start`` and one more assignment.  ``vectors``: (vec_id, embedding) as ``kept`` gives
    them; component x counts as floor(scale * x), distances are squared."""
    spark = vectors.sparkSession
    ship_package(spark)
    edges = [dim * s // shards for s in range(shards + 1)]
    written = stage(_chunks(vectors, dim, edges), "blocks")
    first = integers(np.array(start, np.float64).reshape(len(start), dim), scale)
    slices = [first[:, a:b] for a, b in zip(edges, edges[1:])]
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), written.count()))
    width = [b - a for a, b in zip(edges, edges[1:])]

    def block(r) -> tuple[tuple[int, int], bytes]:
        return (r["shard"], r["chunk"]), bytes(r["data"])

    dealt = written.select("shard", "chunk", "data").rdd.map(block).partitionBy(parts)
    blocks = dealt.mapPartitions(
        lambda rows: ((key, integers(np.frombuffer(data, "<f8").reshape(-1, width[key[0]]), scale)) for key, data in rows),
        preservesPartitioning=True)
    for _ in range(rounds):
        slices = _updated(blocks, _assigned(blocks, slices, parts), slices, parts)

    def row(x) -> tuple[int, bytearray, bytearray]:
        chunk, (labels, distances) = x
        fits = [d if d < 2**63 else -1 for d in distances.tolist()]
        return chunk, bytearray(labels.astype("<i4").tobytes()), bytearray(np.array(fits, "<i8").tobytes())

    last = stage(spark.createDataFrame(_assigned(blocks, slices, parts).map(row), "chunk long, labels binary, distances binary"),
                 "assigned")
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                labels, distances = (np.frombuffer(batch.column(c)[i].as_py(), t) for c, t in (("labels", "<i4"), ("distances", "<i8")))
                yield pa.RecordBatch.from_arrays([batch.column("ids")[i].values, pa.array(labels), pa.array(distances, mask=distances < 0)],
                                                 ["vec_id", "cluster", "distance"])

    ids = written.filter("shard = 0").select("chunk", "ids")
    out = map_arrow(last.join(ids, "chunk").select("ids", "labels", "distances"), spread, f"vec_id {kind}, cluster int, distance long")
    return out, np.concatenate(slices, 1).tolist() if slices else []


def report(vectors: DataFrame, k: int = 40, dim: int = 64, rounds: int = 5, seed: int = 2, shards: int = SHARDS) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of all kept
    vectors, from the ``k`` first by hash."""
    spark = vectors.sparkSession
    own = kept(vectors, dim)
    start = first_by_hash(own, k, seed)
    found, centroids = lloyd(own, start, dim, rounds, shards)
    found = stage(found, "clusters")
    names = spark.createDataFrame([(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids)],
                                  "cluster int, centroid_sha256 string")

    def total(fit: Column, beyond: Column) -> Column:
        return F.when((beyond == 0) & (fit <= 2**63 - 1), fit.cast("long"))

    d = F.col("distance").cast("decimal(38,0)")
    per = found.groupBy("cluster").agg(F.sum(d).alias("fit"), F.count_if(F.col("distance").isNull()).alias("beyond"))
    every = per.agg(F.sum("fit").alias("fit"), F.sum("beyond").alias("beyond")).select(total(F.col("fit"), F.col("beyond"))).scalar()
    sizes = per.select("cluster", total(F.col("fit"), F.col("beyond")).alias("cluster_inertia"), every.alias("inertia"))
    return found.join(F.broadcast(sizes.join(names, "cluster")), "cluster").select(      # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
