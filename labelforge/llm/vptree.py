"""Nearest neighbours by inner product with vantage-point trees per shard.

Largest inner product becomes smallest Euclidean distance by one more
coordinate, sqrt(M^2 - |x|^2) for vectors (M the largest norm of the shard) and
0 for queries.  Every shard holds at most about ``SHARD`` vectors and one tree:
a node keeps a vantage point and the range of distances from it to the vectors
of either half.  A query skips a half whose range lies farther from its own
distance than its k-th best so far -- with ``factor`` f, when f times that gap
exceeds the k-th best distance.  f = 1 is the triangle inequality, exact; a
larger f skips more and may miss.  All queries of a block walk a tree together,
each starting from the leaf it falls into.

Scores are sums over the original vectors in double precision, component by
component.  Equal vectors of a shard are one point of its tree with their
smallest ids (more than k copies cannot all be among the k nearest).  Points are
numbered by smallest id, and a query keeps the best by (score, number), at least
k + 1 because of its own row: of points with equal scores, however many, those
with the smallest ids stay.  A fast product only tells, up to its rounding error,
which points are worth their score.

Defined cases: a vector that is null, empty, zero, or holds a null or
non-finite component takes no part, nor does a row without id; vectors meet
vectors of their own length only; rows that repeat an id are separate rows, as
queries and as candidates, and a query leaves out its own row only; fewer than k candidates give them all; other columns are
ignored.

Scale: the query set is a stated share of the rows, so blocks of queries meet
shards: trees are built once and written, each block goes to each shard, and
only k rows per query and shard come out and are merged by a group limit.
"""

from __future__ import annotations

import io
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, stage

SHARD = 16_384      # vectors per shard, about
BLOCK = 4_096       # queries per block, about
LEAF = 48
SPARE = 12          # rows kept beyond k, which widens the reach of a search by a larger factor


def pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpack(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as f:
        return {k: f[k] for k in f.files}


def build(ids: np.ndarray, vectors: np.ndarray, k: int, rows: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """A tree over a shard as flat arrays.  ``order`` lists points; node n covers
    order[begin:end], its vantage point first; children 0 are leaves' marks.  ``rows``
    tells rows apart (without it ids do)."""
    rows = ids if rows is None else rows
    by_id = np.lexsort((rows, ids))
    ids, rows, vectors = ids[by_id], rows[by_id], np.ascontiguousarray(vectors[by_id])
    points, earliest, where = np.unique(vectors, axis=0, return_index=True, return_inverse=True)
    by_first = np.argsort(earliest)                            # points in the order of their smallest ids
    points, where = points[by_first], np.argsort(by_first)[where.ravel()]
    at = np.argsort(where, kind="stable")
    first = np.searchsorted(where[at], np.arange(len(points)))
    near = np.arange(len(at)) - first[where[at]] <= k          # k + 1 smallest ids of each point
    kept_ids, kept_rows, kept_of = ids[at][near], rows[at][near], where[at][near]
    starts = np.searchsorted(kept_of, np.arange(len(points) + 1))

    norms = (points.astype(np.float64) ** 2).sum(1)
    top = norms.max()
    lifted = np.concatenate([points.astype(np.float64), np.sqrt(np.maximum(top - norms, 0))[:, None]], 1)
    order = np.arange(len(points))
    nodes: list[list[float]] = []
    todo = [(0, len(points), -1, 0)]
    while todo:
        begin, end, parent, side = todo.pop()
        n = len(nodes)
        nodes.append([begin, end, 0, 0, 0.0, 0.0, 0.0, 0.0])
        if parent >= 0:
            nodes[parent][2 + side] = n
        if end - begin <= LEAF:
            continue
        own = order[begin:end]
        # vantage point: the one farthest from the middle of the set
        v = int(((lifted[own] - lifted[own].mean(0)) ** 2).sum(1).argmax())
        own[0], own[v] = own[v], own[0]
        d = np.sqrt(((lifted[own[1:]] - lifted[own[0]]) ** 2).sum(1))
        by = np.argsort(d, kind="stable")
        own[1:] = own[1:][by]
        d = d[by]
        half = len(d) // 2
        nodes[n][4:8] = [d[0], d[half - 1], d[half], d[-1]]
        todo += [(begin + 1, begin + 1 + half, n, 0), (begin + 1 + half, end, n, 1)]
    return {"points": points, "ids": kept_ids, "rows": kept_rows, "starts": starts, "order": order, "top": np.array([top]),
            "nodes": np.array(nodes)}


def search(tree: dict[str, np.ndarray], qids: np.ndarray, queries: np.ndarray, k: int, factor: float,
           qrows: np.ndarray | None = None) -> tuple:
    """(query row, vec id, score) arrays of each query's k best rows of the shard,
    and how many points were looked at.  ``qrows``: the queries' rows (without it, their ids)."""
    qrows = qids if qrows is None else qrows
    points, order, nodes = tree["points"].astype(np.float64), tree["order"], tree["nodes"]
    q = queries.astype(np.float64)
    top = float(tree["top"][0])
    q_norm = (q ** 2).sum(1)
    norms = (points ** 2).sum(1)
    lift = np.sqrt(np.maximum(top - norms, 0))
    keep = min(k + 1 + SPARE, len(points))
    best = np.full((len(q), keep), -np.inf)                     # scores, best first
    best_at = np.full((len(q), keep), -1)
    slack = 1e-6 * math.sqrt(top + 1e-300)
    # twice what a product and a score can be off, in any order of summation
    off = 4 * (q.shape[1] + 2) * np.finfo(np.float64).eps * np.sqrt(q_norm * top)
    looked = 0

    def offer(rows: np.ndarray, which: np.ndarray, products: np.ndarray):
        nonlocal looked
        looked += products.size
        worth = products >= (best[rows, -1] - off[rows])[:, None]
        some = worth.any(1)
        rows, worth = rows[some], worth[some]
        if not len(rows):
            return
        r, c = np.nonzero(worth)
        exact = np.zeros(len(r))
        for d in range(q.shape[1]):                             # component by component
            exact += q[rows[r], d] * points[which[c], d]
        scores = np.full(worth.shape, -np.inf)
        scores[r, c] = exact
        both = np.concatenate([best[rows], scores], 1)
        at = np.concatenate([best_at[rows], np.where(worth, which, -1)], 1)
        pick = np.lexsort((at, -both), axis=1)[:, :keep]
        best[rows] = np.take_along_axis(both, pick, 1)
        best_at[rows] = np.take_along_axis(at, pick, 1)

    def reach(rows: np.ndarray) -> np.ndarray:
        """Distance beyond which nothing can enter a query's best."""
        worst = best[rows, -1]
        return np.where(np.isneginf(worst), np.inf, np.sqrt(np.maximum(q_norm[rows] + top - 2 * np.where(
            np.isneginf(worst), 0, worst), 0)))

    def to_vantage(n: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = order[int(nodes[n][0])]
        dots = q[rows] @ points[p]
        return dots, np.sqrt(np.maximum(q_norm[rows] + top - 2 * dots, 0))

    # start: the leaf that each query falls into
    todo = [(0, np.arange(len(q)))]
    home = np.full(len(q), -1)
    while todo:
        n, rows = todo.pop()
        node = nodes[n]
        if not node[2]:
            home[rows] = n
            which = order[int(node[0]):int(node[1])]
            offer(rows, which, q[rows] @ points[which].T)
            continue
        _, d = to_vantage(n, rows)
        inner = d <= (node[5] + node[6]) / 2
        todo += [(int(node[2 + side]), rows[m]) for side, m in ((0, inner), (1, ~inner)) if m.any()]

    todo = [(0, np.arange(len(q)), np.zeros(len(q)))]
    while todo:
        n, rows, gap = todo.pop()
        alive = factor * gap <= reach(rows) + slack             # the best may have moved on
        rows, gap = rows[alive], gap[alive]
        if not len(rows):
            continue
        node = nodes[n]
        if not node[2]:
            rows = rows[home[rows] != n]
            if len(rows):
                which = order[int(node[0]):int(node[1])]
                offer(rows, which, q[rows] @ points[which].T)
            continue
        dots, d = to_vantage(n, rows)
        offer(rows, order[int(node[0]):int(node[0]) + 1], dots[:, None])
        gaps = [np.maximum(np.maximum(d - node[5], node[4] - d), gap), np.maximum(np.maximum(d - node[7], node[6] - d), gap)]
        # the half that most queries are nearer to comes first (last on the stack)
        sides = (0, 1) if (gaps[1] < gaps[0]).mean() > 0.5 else (1, 0)
        todo += [(int(node[2 + s]), rows, gaps[s]) for s in sides]

    out_q, out_v, out_s = [], [], []
    for i in range(len(q)):
        got = [(-s, int(tree["ids"][j])) for s, p in zip(best[i], best_at[i]) if p >= 0
               for j in range(tree["starts"][p], tree["starts"][p + 1]) if tree["rows"][j] != qrows[i]]
        for s, v in sorted(got)[:k]:
            out_q.append(int(qrows[i]))
            out_v.append(v)
            out_s.append(-s)
    return np.array(out_q, np.int64), np.array(out_v, np.int64), np.array(out_s, np.float64), looked


def _grouped(per_group: Callable, by: tuple[str, ...], names: list[str], types: list) -> Callable:
    from .neardup import groups

    def run(batches):
        for group in groups(batches, by):
            rows = per_group(group)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names)
    return run


def _matrix(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vectors = group.column("v").combine_chunks()
    dim = group.column("dim")[0].as_py()
    return group.column("vec_id").to_numpy(), group.column("row").to_numpy(), np.asarray(vectors.flatten().to_numpy(zero_copy_only=False)).reshape(-1, dim)


def usable(table: DataFrame) -> DataFrame:
    """(row, vec_id, v, dim) of the rows that take part; ``row`` tells them apart once written."""
    v = F.col("embedding")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (table.filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)).filter(~odd)
            .filter(F.exists(v, lambda x: x != 0))
            .select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"),
                    F.size(v).alias("dim")))


def nearest(table: DataFrame, is_query: Column, k: int = 20, factor: float = 1.0, shard: int = SHARD,
            block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of (vec_id, embedding) with the
    largest inner product with each row for which ``is_query`` holds."""
    rows = stage(usable(table), "vectors")
    n = rows.count()
    shards = max(1, math.ceil(n / shard))
    blocks = max(1, math.ceil(rows.filter(is_query).count() / block))
    hashed = F.xxhash64("row")

    def one_blob(make):
        def per_group(group):
            return [[group.column("dim")[0].as_py()], [group.column("part")[0].as_py()], [make(*_matrix(group))]]
        return _grouped(per_group, ("dim", "part"), ["dim", "part", "blob"], [pa.int32(), pa.int64(), pa.binary()])

    def blobs(df, parts, make):
        df = df.withColumn("part", F.pmod(hashed, F.lit(parts))).select("dim", "part", "row", "vec_id", "v")
        df = df.repartition("dim", "part").sortWithinPartitions("dim", "part", "vec_id")
        return map_arrow(df, one_blob(make), "dim int, part long, blob binary")

    trees = stage(blobs(rows, shards, lambda ids, at, v: pack(**build(ids, v, k, at))), "trees")
    asked = blobs(rows.filter(is_query), blocks, lambda ids, at, v: pack(ids=ids, rows=at, vectors=v))
    pairs = trees.withColumnRenamed("blob", "tree").join(
        asked.select("dim", "blob", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("part")),
        ["dim", "part"])

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                asked = unpack(batch.column("blob")[row].as_py())
                q, v, s, _ = search(unpack(batch.column("tree")[row].as_py()), asked["ids"], asked["vectors"], k, factor, asked["rows"])
                by = np.argsort(asked["rows"])
                ids = asked["ids"][by][np.searchsorted(asked["rows"][by], q)]
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(ids), pa.array(v), pa.array(s)],
                                                 ["row", "query_id", "vec_id", "score"])

    found = map_arrow(pairs, run, "row long, query_id long, vec_id long, score double")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
