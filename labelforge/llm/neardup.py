"""MinHash near-dedup by a multi-index Hamming join.

A document is its set of word shingles (64-bit hashes, full text).  Equal sets
collapse to one node first, so thousands of copies cost one signature.

1. Every node gets ``K`` minima of ``BITS`` bits.  For similarity t, positions
   differ with probability 1-t; ``plan`` takes the radius r that a pair at the
   threshold exceeds with probability at most ``MISS``.
2. Multi-index join: the K positions are cut into m = r//2+1 chunks.  By the
   pigeonhole principle any pair within radius r has a chunk with at most one
   differing position, so each chunk is indexed once per allowed error (the
   chunk with one position left out).  Pairs within r are found for certain.
3. Nodes that share a key are compared by signature in blocks; only a spanning
   forest of the pairs within r leaves a block.
4. Connected nodes form clusters.  Inside a cluster the full sets are compared
   exactly (block against block), again leaving spanning forests of the
   confirmed links, whose components are the result.

Defined cases: null or empty text has no shingles and is its own component; a
text with fewer words than a shingle is one shingle of its whole sequence; a
row with a null id takes no part (component null, kept); rows that share an id
are judged by their own texts; extra columns are ignored.

Scale: all shuffles are keyed by chunk key, node or cluster.  A key with more
than ``BLOCK`` nodes is dealt over block pairs, so no task holds more than two
blocks; the comparisons inside one giant family of distinct near copies stay
quadratic in that family, but a node that is already connected is compared with
unconnected ones only, and nothing quadratic is emitted.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import GOLDEN, as_bytes, map_arrow, mix64, pieces, stage
from .graph import components

K = 64                 # minima per signature
BITS = 16              # bits kept of each
MISS = 1e-5            # chance that a pair exactly at the threshold lies beyond the radius
BLOCK = 1024           # nodes compared in one block
BLOCK_BYTES = 32 << 20  # bytes of shingle sets in one block
SPREAD = 24            # blocks into which a cluster is dealt while they hold over SPREAD_ROWS nodes
SPREAD_ROWS = 128
_WORDS = 300_000       # word hashes a task keeps at hand
_WORD = r"[^\x20\x09-\x0D]"

_rng = np.random.default_rng(20240229)
_A = _rng.integers(0, 2**63, K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, K, dtype=np.uint64)
_STEP = np.uint64(0xD6E8FEB86659FD93)


class WordHashes(dict):
    """word -> 64-bit hash, a bounded memo."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: bytes, size: int, memo: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a whole text (ASCII case folded)."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        if len(h) < size:
            acc = np.full(1, len(h), np.uint64)
            for x in h:
                acc = mix64(acc * _STEP + x)
            return acc
        acc = h[:len(h) - size + 1].copy()
        for j in range(1, size):
            acc = acc * _STEP + h[j:len(h) - size + 1 + j]
    return np.unique(mix64(acc))


def signature(s: np.ndarray) -> np.ndarray:
    """K minima of a set under K multiply-add hashes, BITS bits of each."""
    best = np.full(K, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(s), 2048):
            np.minimum(best, (s[i:i + 2048, None] * _A + _B).min(axis=0), out=best)
        return (mix64(best) >> np.uint64(64 - BITS)).astype(np.uint16)


def plan(threshold: float, miss: float = MISS) -> tuple[int, list[np.ndarray]]:
    """Radius r and the chunks of signature positions (one error allowed in each)."""
    p, tail, r = 1 - threshold, 1.0, -1
    while tail > miss:
        r += 1
        tail -= math.comb(K, r) * p**r * (1 - p) ** (K - r)
    return r, np.array_split(np.arange(K), r // 2 + 1)


def chunk_keys(sigs: np.ndarray, chunks: list[np.ndarray]) -> np.ndarray:
    """(rows, K) keys: each chunk once per position left out of it."""
    out = []
    wide = sigs.astype(np.uint64)
    with np.errstate(over="ignore"):
        for c, positions in enumerate(chunks):
            for left_out in positions:
                acc = np.full(len(sigs), (c * K + int(left_out) + 1), np.uint64) * GOLDEN
                for p in positions:
                    if p != left_out:
                        acc = mix64(acc * _STEP + wide[:, p])
                out.append(acc)
    return np.stack(out, 1).view(np.int64)


# ------------------------------------------------------------------ inside tasks
def _sign(shingle: int):
    """Every column but the text, with size, digest and signature of the text's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for whole in batches:
            for batch in pieces(whole, "text"):
                n, digests, sigs = [], [], []
                for text in as_bytes(batch.column("text")):
                    s = shingles(text, shingle, memo)
                    n.append(len(s))
                    digests.append(blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    sigs.append(signature(s).tobytes() if len(s) else None)
                rest = batch.drop_columns(["text"])
                yield pa.RecordBatch.from_arrays(
                    [*rest.columns, pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary())],
                    [*rest.schema.names, "n_shingles", "digest", "sig"])
    return run


def _keys(chunks: list[np.ndarray]):
    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                sigs = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint16).reshape(-1, K)
                keys = chunk_keys(sigs, chunks)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), pa.array(np.repeat(batch.column("node").to_numpy(), keys.shape[1]))],
                    ["key", "node"])
    return run


def groups(batches: Iterator[pa.RecordBatch], by: tuple[str, ...]) -> Iterator[pa.Table]:
    """Runs of equal ``by`` columns in a sorted partition, across batch borders."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = np.stack([batch.column(c).to_numpy() for c in by], 1)
        cuts = [0, *(np.flatnonzero((cols[1:] != cols[:-1]).any(1)) + 1).tolist(), batch.num_rows]
        if held and tuple(cols[0]) != last:
            yield pa.Table.from_batches(held)
            held = []
        for a, b in itertools.pairwise(cuts):
            held.append(batch.slice(a, b - a))
            if b < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
        last = tuple(cols[-1])
    if held:
        yield pa.Table.from_batches(held)


def forest(n: int, near) -> list[tuple[int, int]]:
    """Spanning forest of a graph over range(n); ``near(i, rest)`` says which of
    the nodes ``rest`` are linked with i.  Every node is expanded once, against
    the nodes not reached yet."""
    rest, out = np.arange(n), []
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            i = queue.pop()
            hit = near(i, rest)
            if hit.any():
                found = rest[hit].tolist()
                out += [(i, j) for j in found]
                queue += found
                rest = rest[~hit]
    return out


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _emit(per_group, by: tuple[str, ...]):
    def run(batches):
        found: list[tuple[int, int]] = []
        for group in groups(batches, by):
            found += per_group(group)
            if len(found) > 50_000:
                yield _edges(found)
                found = []
        if found:
            yield _edges(found)
    return run


def _near_signatures(radius: int):
    def per_group(group: pa.Table) -> list[tuple[int, int]]:
        nodes = group.column("node").to_numpy()
        sigs = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint16).reshape(-1, K)
        pairs = forest(len(nodes), lambda i, rest: (sigs[rest] != sigs[i]).sum(1) <= radius)
        return [(int(nodes[i]), int(nodes[j])) for i, j in pairs]
    return per_group


def _near_sets(num: int, den: int):
    def per_group(group: pa.Table) -> list[tuple[int, int]]:
        nodes = group.column("node").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in group.column("set").to_pylist()]
        sizes = np.array([len(s) for s in sets])
        if len(sets) == 2:
            both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
            linked = den * both >= num * (sizes.sum() - both)
            return [(int(nodes[0]), int(nodes[1]))] if linked else []
        ids = np.unique(np.concatenate(sets), return_inverse=True)[1].astype(np.int32)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        mark = np.zeros(int(ids.max()) + 1, bool)
        flat = {"of": np.arange(len(sets)), "ids": ids, "at": starts[:-1]}

        def near(i: int, rest: np.ndarray) -> np.ndarray:
            if 2 * len(rest) < len(flat["of"]):      # keep only what is still unreached
                flat["of"] = rest
                flat["ids"] = np.concatenate([ids[starts[j]:starts[j + 1]] for j in rest])
                flat["at"] = np.concatenate([[0], np.cumsum(sizes[rest])[:-1]])
            own = ids[starts[i]:starts[i + 1]]
            mark[own] = True
            both = np.add.reduceat(mark[flat["ids"]], flat["at"], dtype=np.int64)
            mark[own] = False
            both = both[np.searchsorted(flat["of"], rest)]
            return den * both >= num * (sizes[i] + sizes[rest] - both)

        return [(int(nodes[i]), int(nodes[j])) for i, j in forest(len(sets), near)]
    return per_group


def _sets(shingle: int):
    def run(batches):
        memo = WordHashes()
        for whole in batches:
            for batch in pieces(whole, "text", 2 << 20):
                sets = [shingles(t, shingle, memo).tobytes() for t in as_bytes(batch.column("text"))]
                # rows that share an id with another text are not this node
                own = [blake2b(s, digest_size=16).digest() == d for s, d in zip(sets, batch.column("digest").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("cluster", "blocks", "node")), pa.array(sets, pa.binary())],
                    ["cluster", "blocks", "node", "set"]).filter(pa.array(own, pa.bool_()))
    return run


# ------------------------------------------------------------------ DataFrames
def in_blocks(members: DataFrame, blocks: str) -> DataFrame:
    """``members`` with the block pair (bi, bj) of each comparison they take part
    in; ``blocks`` is the number of blocks of the member's group."""
    own = F.pmod(F.xxhash64("node"), F.col(blocks))
    return (members.withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1)))
            .withColumn("bi", F.least("own", "other")).withColumn("bj", F.greatest("own", "other"))
            .drop("own", "other", blocks))


def candidate_edges(nodes: DataFrame, radius: int, chunks: list[np.ndarray]) -> DataFrame:
    """Spanning edges (a, b) of the pairs of ``nodes`` (node, sig) within ``radius``."""
    keys = map_arrow(nodes.select("sig", "node"), _keys(chunks), "key long, node long")
    shared = stage(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                   .select("key", F.ceil(F.col("n") / BLOCK).alias("blocks")), "shared-keys")
    members = in_blocks(keys.join(shared, "key"), "blocks").join(nodes.select("node", "sig"), "node")
    by = ("key", "bi", "bj")
    sorted_ = members.select(*by, "node", "sig").repartition(*by).sortWithinPartitions(*by)
    return (map_arrow(sorted_, _emit(_near_signatures(radius), by), "a long, b long").distinct())


def confirmed_edges(docs: DataFrame, clusters: DataFrame, shingle: int, num: int, den: int) -> DataFrame:
    """Spanning edges of the links den*|A&B| >= num*|A|B| inside each cluster of
    ``clusters`` (cluster, node, doc_id, digest, n_shingles), on full sets."""
    size = stage(clusters.groupBy("cluster").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n_shingles") * 8 / BLOCK_BYTES),
                   F.least(F.ceil(F.count(F.lit(1)) / SPREAD_ROWS), F.lit(SPREAD))).alias("blocks")), "cluster-blocks")
    members = stage(clusters.drop("n_shingles").join(size, "cluster"), "cluster-members")
    by = ("cluster", "bi", "bj")
    # shuffled at every size: the members are a share of the documents, so they grow with them
    texts = (docs.select("doc_id", "text").join(members.hint("merge"), "doc_id")
             .select("cluster", "blocks", "node", "digest", "text"))
    sets = map_arrow(texts, _sets(shingle), "cluster long, blocks long, node long, set binary")
    sorted_ = in_blocks(sets, "blocks").select(*by, "node", "set").repartition(*by).sortWithinPartitions(*by)
    return (map_arrow(sorted_, _emit(_near_sets(num, den), by), "a long, b long").distinct())


def judged(docs: DataFrame, shingle: int, num: int, den: int) -> DataFrame:
    """The rows of ``docs`` (doc_id long, text, more) without their texts, with n_shingles,
    digest (null: no shingles), root (one number for all rows linked with other texts,
    else null) and least (the smallest doc_id of the texts linked or equal, else null)."""
    rest = docs.drop("text")
    schema = "".join(f"`{c}` {kind}, " for c, kind in rest.dtypes)
    signed = stage(map_arrow(docs, _sign(shingle), f"{schema}n_shingles long, digest binary, sig binary"), "signed")
    nodes = stage(signed.filter("digest is not null and doc_id is not null").groupBy("digest")
                  .agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"),
                       F.first("sig").alias("sig"), F.count(F.lit(1)).alias("copies"))
                  .withColumn("node", F.monotonically_increasing_id()), "nodes")
    radius, chunks = plan(num / den)
    clusters = components(candidate_edges(nodes, radius, chunks)).withColumnRenamed("component", "cluster")
    clusters = stage(clusters.join(nodes.select("node", "doc_id", "digest", "n_shingles"), "node"), "clusters")
    links = components(confirmed_edges(docs, clusters, shingle, num, den))
    named = stage(links.join(nodes.select("node", "doc_id"), "node"), "linked")
    least = stage(named.groupBy("component").agg(F.min("doc_id").alias("least")), "components")
    found = (nodes.select("node", "digest", "doc_id", "copies")
             .join(named.join(least, "component").select("node", F.col("component").alias("root"), "least"), "node", "left")
             .filter("root is not null or copies > 1")
             .select("digest", "root", F.coalesce("least", "doc_id").alias("least")))
    return signed.drop("sig").join(stage(found, "digest-components"), "digest", "left")


def near_duplicates(docs: DataFrame, shingle: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per document of (doc_id, text).

    Documents are linked when den * |A & B| >= num * |A | B| over their sets of
    ``shingle``-word shingles."""
    rows = judged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), shingle, num, den)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"),
                       F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, shingle: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` (all columns) that are first of their group, by doc_id, then a
    digest of the text.  Every row is judged by its own text: rows that repeat an id are
    separate, but of rows equal in id and text one stays; rows with a null id or without
    words all stay.  ``docs`` is read four times and not copied: a row is found again by
    id and text, so its texts cross the network for the verdict once."""
    rows = docs.withColumn("__lf_key", F.md5(F.col("text").cast("binary")))
    single = F.col("doc_id").isNull() | ~F.coalesce(F.col("text").rlike(_WORD), F.lit(False))
    named = rows.filter(~single)
    verdict = judged(named.select(F.xxhash64("doc_id", "text").alias("doc_id"), "text", F.col("doc_id").alias("__lf_id"), "__lf_key"),
                     shingle, num, den)
    first = (verdict.groupBy("root", F.when(F.col("root").isNull(), F.col("digest")).alias("own"))
             .agg(F.min(F.struct("__lf_id", "__lf_key")).alias("m")).select(F.col("m.__lf_id").alias("doc_id"), "m.__lf_key"))
    same = Window.partitionBy("doc_id", "__lf_key").orderBy("__lf_key")
    kept = (named.join(stage(first, "kept"), ["doc_id", "__lf_key"], "left_semi")
            .withColumn("__lf_nth", F.row_number().over(same)).filter("__lf_nth = 1"))
    return rows.filter(single).drop("__lf_key").unionByName(kept.drop("__lf_key", "__lf_nth"))
