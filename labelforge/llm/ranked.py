"""Ranked lexical search: a document FP-tree with branch-and-bound per item.

Every document becomes its restricted term vector: the terms that some item
asks for, with their counts, in order of frequency.  In that order documents share
trie paths.  A task holds a shard of documents as such a trie, cut off where a
node has at most ``LEAF`` documents.  Each node keeps, over all documents below it, the
largest count of every term and the smallest length norm m; as a term's share
of a score grows with its count and shrinks with m, both together bound the
score of every document below.  An item walks the trie depth first, best bound
first, and leaves out every node whose bound lies below the k-th best score it
has so far (equal bounds are walked: smaller ids win ties).  Documents of the leaves
it reaches are scored exactly.  The best found carry over to the task's next shard.

Scores are integers throughout: see ``weight`` and ``norm``; a score sums
w * ((1000000000 * tf) div (1000 * tf + 12 * m)) over the item's terms.

Defined cases: null or empty text has no terms and is found by nothing, an item
without terms or text finds nothing; of equal scores the smaller id wins, null ids
last; rows that repeat an id (of documents or items) are separate; empty tables
give no rows; other columns are ignored.

Scale: items are the query set.  They are taken in blocks of at most ``ITEMS`` items
and ``CHARS`` bytes of text (or one item), so what travels to the tasks is bounded; each block
meets all documents once.  Texts are read once per block, the rest runs on restricted
vectors.  A shard has at most ``SHARD`` documents and ``POSTINGS`` counts;
only k rows per item and task come out and are merged by a group limit.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import as_bytes, map_arrow, pieces, stage

ITEMS = 2_000
CHARS = 4_000_000
SHARD = 16_384
POSTINGS = 4_000_000
LEAF = 32
SLICE = 8 << 20

# ASCII letters in lower case, digits and all bytes of other characters; the rest parts terms.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text."""
    return text.translate(_TABLE).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def norm(n: int, n_docs: int, n_terms: int) -> int:
    """m of a document with n terms."""
    return 100 - 25 + (25 * n * n_docs) // n_terms


def restricted(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(doc_id, n, terms, tfs): the number of all terms of each document, and places in
    ``vocabulary`` with counts of those it holds.  Documents without terms are left out."""
    place = {t: i for i, t in enumerate(vocabulary)}

    def run(batches):
        for whole in batches:
            for batch in pieces(whole, "text", SLICE):
                kept, n, ends, at, tf = [], [], [0], [], []
                for i, text in enumerate(as_bytes(batch.column("text"))):
                    words = terms(text)
                    if not words:
                        continue
                    own = Counter(filter(place.__contains__, words))
                    kept.append(i)
                    n.append(len(words))
                    at += map(place.__getitem__, own)
                    tf += own.values()
                    ends.append(len(at))
                ends = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(kept, pa.int64())), pa.array(n, pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.array(at, pa.int32())),
                     pa.ListArray.from_arrays(ends, pa.array(tf, pa.int64()))], ["doc_id", "n", "terms", "tfs"])

    narrow = docs.select("doc_id", "text")
    return map_arrow(narrow, run, f"doc_id {dict(narrow.dtypes)['doc_id']}, n long, terms array<int>, tfs array<long>")


def share(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """(1000000000 * tf) div (1000 * tf + 12 * m)."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Tree:
    """The trie of a shard as flat arrays.

    Documents lie in trie order, so a node is a range of them.  Node 0 is the root,
    children of a node are neighbours.  ``f`` holds a count's share of the
    score without the weight: of every posting, and (from the largest count and the
    smallest m) of every term of every node."""

    def __init__(self, starts: np.ndarray, terms: np.ndarray, tfs: np.ndarray, m: np.ndarray, leaf: int = LEAF):
        n = len(m)
        # trie order: vectors, each in its own order of terms, sorted like words
        paths = [terms[a:b].tobytes() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]   # big-endian: bytes sort like terms
        self.order = np.array(sorted(range(n), key=paths.__getitem__), np.int64)
        size = np.diff(starts)[self.order]
        take = np.repeat(starts[:-1][self.order] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        self.starts = np.concatenate([[0], np.cumsum(size)])
        self.terms, tfs = terms[take].astype(np.int64), tfs[take]
        m = m[self.order]
        self.f = share(tfs, np.repeat(m, size))
        # nodes, parents before children
        begin, end, depth, first, last = [0], [n], [0], [0], [0]
        at = 0
        while at < len(begin):
            a, b, d = begin[at], end[at], depth[at]
            first[at] = len(begin)
            if b - a > leaf:
                # the terms all of them share next need no nodes: the first and the last path tell
                x, y = (self.terms[self.starts[i]:self.starts[i + 1]][d:] for i in (a, b - 1))
                differ = np.flatnonzero(x[:len(y)] != y[:len(x)])
                d += int(differ[0]) if len(differ) else min(len(x), len(y))
                has = size[a:b] > d
                term = np.full(b - a, -1)
                term[has] = self.terms[self.starts[a:b][has] + d]
                edges = np.concatenate([[0], np.flatnonzero(np.diff(term)) + 1, [b - a]])
                for x, y in zip(edges[:-1].tolist(), edges[1:].tolist()):
                    if term[x] < 0:                     # documents that end here are alike: no deeper level
                        cuts = [*range(x, y, leaf), y]
                        begin += [a + c for c in cuts[:-1]]
                        end += [a + c for c in cuts[1:]]
                        depth += [-1] * (len(cuts) - 1)
                    else:
                        begin.append(a + x)
                        end.append(a + y)
                        depth.append(d + 1)
                first += [0] * (len(begin) - len(first))
                last += [0] * (len(begin) - len(last))
            last[at] = len(begin)
            at += 1
        self.begin, self.end, self.first, self.last = map(np.array, (begin, end, first, last))
        # largest count of every term and smallest m, from the leaves up
        tables: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(begin)
        least = np.zeros(len(begin), np.int64)
        for i in reversed(range(len(begin))):
            if last[i] == first[i]:
                own = slice(self.starts[begin[i]], self.starts[end[i]])
                keys, counts = self.terms[own], tfs[own]
                least[i] = m[begin[i]:end[i]].min() if end[i] > begin[i] else 0
            else:
                below = [tables[c] for c in range(first[i], last[i])]
                keys, counts = np.concatenate([t[0] for t in below]), np.concatenate([t[1] for t in below])
                least[i] = least[first[i]:last[i]].min()
            by = np.argsort(keys, kind="stable")
            keys, counts = keys[by], counts[by]
            edge = np.flatnonzero(np.diff(keys, prepend=-1))
            tables[i] = keys[edge], np.maximum.reduceat(counts, edge) if len(edge) else counts
        width = np.array([len(t[0]) for t in tables])
        self.node_starts = np.concatenate([[0], np.cumsum(width)])
        self.node_terms = np.concatenate([t[0] for t in tables])
        self.node_f = share(np.concatenate([t[1] for t in tables]), np.repeat(least, width))

    @staticmethod
    def _sums(weights: np.ndarray, starts: np.ndarray, terms: np.ndarray, f: np.ndarray, a: int, b: int) -> np.ndarray:
        """sum of weight * f of rows a .. b - 1."""
        x, y = starts[a], starts[b]
        total = np.concatenate([[0], np.cumsum(weights[terms[x:y]] * f[x:y])])
        own = starts[a:b + 1] - x
        return total[own[1:]] - total[own[:-1]]

    def search(self, weights: np.ndarray, ids: np.ndarray, best: list[tuple[int, int]], k: int) -> tuple[list[tuple[int, int]], int]:
        """(the k best (-score, place of id), documents scored): ``best`` with those of
        this shard.  ``weights``: the item's weight of every term, ``ids``: the
        documents' places in the order of ids."""
        looked = 0
        todo = [(-1, 0)]                                        # (bound below zero: not known, node)
        while todo:
            bound, node = todo.pop()
            if len(best) == k and -best[-1][0] > bound >= 0:
                continue
            a, b = self.first[node], self.last[node]
            if a == b:
                a, b = self.begin[node], self.end[node]
                looked += b - a
                score = self._sums(weights, self.starts, self.terms, self.f, a, b)
                good = np.flatnonzero(score > (-best[-1][0] - 1 if len(best) == k else 0))
                if len(good):
                    own = zip((-score[good]).tolist(), ids[self.order[a:b][good]].tolist())
                    best = sorted([*best, *own])[:k]
                continue
            bounds = self._sums(weights, self.node_starts, self.node_terms, self.node_f, a, b)
            least = max(1, -best[-1][0]) if len(best) == k else 1
            good = np.flatnonzero(bounds >= least)
            good = good[np.argsort(bounds[good], kind="stable")]          # the best is on top of the stack
            todo += zip(bounds[good].tolist(), (a + good).tolist())
        return best, looked


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in tables of at most ``SHARD`` rows and about ``POSTINGS`` counts."""
    held, rows, counts = [], 0, 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            sizes = np.cumsum(np.asarray(batch.column("terms").slice(at).value_lengths()))
            take = min(SHARD - rows, max(1, int(np.searchsorted(sizes, POSTINGS - counts, side="right"))))
            held.append(batch.slice(at, take))
            at, rows, counts = at + take, rows + take, counts + int(sizes[min(take, len(sizes)) - 1])
            if rows >= SHARD or counts >= POSTINGS:
                yield pa.Table.from_batches(held)
                held, rows, counts = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _block(docs: DataFrame, items: list[tuple[int, bytes]], k: int) -> DataFrame:
    """(item, doc_id, score) of the k best of every item, of every task."""
    asked = {key: Counter(terms(text)) for key, text in items}
    vocabulary = sorted(set().union(*asked.values()))
    vectors = stage(restricted(docs, vocabulary), "vectors")
    n_docs, n_terms = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
    counts = vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect()
    df = np.zeros(len(vocabulary), np.int64)                    # one row per term of the block
    for t, n in counts:
        df[t] = n
    # places of terms in the order of the paths: rarest first, so what an item asks for parts the trie at the top
    place = np.empty(len(vocabulary), np.int64)
    place[np.lexsort((np.arange(len(df)), df))] = np.arange(len(df))
    at = dict(zip(vocabulary, place.tolist()))
    w = {t: weight(n_docs, int(df[i])) for i, t in enumerate(vocabulary)}
    own = {key: [(at[t], w[t] * n) for t, n in c.items()] for key, c in asked.items() if c}
    width = len(vocabulary)
    kind = vectors.schema["doc_id"].dataType

    def run(batches):
        best: dict[int, list[tuple[int, int]]] = {key: [] for key in own}
        known: list = []                                        # ids of the best so far, by place
        names = pa.array([])
        for shard in _shards(batches):
            # places in the order of ids, null last, among those of this shard and the best so far
            fresh = shard.column("doc_id").combine_chunks()
            names = pa.concat_arrays([names.take(pa.array(known, pa.int64())), fresh]) if known else fresh
            rank = np.empty(len(names), np.int64)
            rank[np.asarray(pc.sort_indices(names, null_placement="at_end"))] = np.arange(len(names))
            names = names.take(pa.array(np.argsort(rank)))
            moved = {old: int(rank[i]) for i, old in enumerate(known)}
            best = {key: sorted((s, moved[d]) for s, d in found) for key, found in best.items()}
            lists = shard.column("terms").combine_chunks()
            size = np.asarray(lists.value_lengths()).astype(np.int64)
            doc = np.repeat(np.arange(len(size)), size)
            t = place[np.asarray(lists.flatten())]
            by = np.lexsort((t, doc))
            m = np.array([norm(n, n_docs, n_terms) for n in shard.column("n").to_pylist()], np.int64)
            tree = Tree(np.concatenate([[0], np.cumsum(size)]), t[by].astype(">i4"),
                        np.asarray(shard.column("tfs").combine_chunks().flatten())[by], m)
            for key, pairs in own.items():
                weights = np.zeros(width, np.int64)
                weights[[p for p, _ in pairs]] = [x for _, x in pairs]
                best[key], _ = tree.search(weights, rank[len(known):], best[key], k)
            known = sorted({d for found in best.values() for _, d in found})
        rows = [(key, d, -s) for key, found in best.items() for s, d in found]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), names.take(pa.array([r[1] for r in rows], pa.int64())),
                 pa.array([r[2] for r in rows], pa.int64())], ["item", "doc_id", "score"])

    return map_arrow(vectors, run, f"item long, doc_id {kind.simpleString()}, score long")


def rank(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents (doc_id, text) for every
    item (item_id, text), highest score first, only scores above 0."""
    asked = stage(items.select(F.monotonically_increasing_id().alias("item"), "item_id", F.col("text").alias("t")), "items")
    found = [_block(docs, block, k) for block in _blocks(asked.select("item", "t").toLocalIterator())]
    every = found[0] if found else _block(docs, [], k)
    for part in found[1:]:
        every = every.unionByName(part)
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    top = every.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return top.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _blocks(rows: Iterator) -> Iterator[list[tuple[int, bytes]]]:
    """(item, text) in blocks of at most ``ITEMS`` items and ``CHARS`` bytes, or one item."""
    block: list[tuple[int, bytes]] = []
    held = 0
    for item, text in rows:
        data = (text or "").encode()
        if block and (len(block) == ITEMS or held + len(data) > CHARS):
            yield block
            block, held = [], 0
        block.append((item, data))
        held += len(data)
    if block:
        yield block
