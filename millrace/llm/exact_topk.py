"""Exact search for the vectors of greatest inner product, by KD-trees in shards.

The components of all vectors become whole numbers, floor(scale * x), so scores are exact. The
upper levels of one KD-tree, fitted on a bounded sample of about SAMPLE rows, deal all rows into
cells and shards (``vectors``). In its task each shard becomes a KD-tree of its own: median splits
of the widest component down to LEAF rows, with the tight bounding box of every node. A box
bounds the score of a query: per component the better of its two ends counts.

Queries search their own shard first. The k-th best score found there, and its id, go along to
the other shards: those whose box cannot reach it are not visited, and the others start from it.
Inside a tree a batch of queries descends level by level, for all of them at once, past nodes
whose bound is too low; then each query visits its leaves in the order of their bounds, best
first, with its k-th score rising, until no bound reaches it. As the box of a node holds those of
its children, this is the order in which a queue of nodes would hand out the leaves.

Defined results: rows with a null id, a null vector or a null or non-finite component take no part.
Vectors of different lengths are compared over their shared leading components; an empty one
scores 0 with all. Ties go to the smaller id. Rows that share an id are candidates each, and none
of them to a query of that id; among queries that share an id the vector least in order asks for
all. Equal rows are rows each, so one of them may appear several times. Empty tables give an empty
result. Whole numbers beyond 10^15 count as 10^15, scores beyond 2^63 - 1 in size as that. Other
columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import vectors
from millrace.llm.common import saved
from millrace.llm.vectors import HIGHEST, LOWEST

SCALE = 64
LEAF = 128
#: Rows, about, on which the split into cells is fitted; all rows are dealt by it.
SAMPLE = 4096


class Splits:
    """The upper levels of a KD-tree, which deal vectors into cells."""

    def __init__(self, x: np.ndarray, cells: int):
        self.depth = max(0, int(np.ceil(np.log2(max(1, cells)))))
        self.at = np.zeros(1 << self.depth, dtype=np.int64)
        self.value = np.zeros(1 << self.depth)
        parts = {1: np.arange(len(x))}
        for node in range(1, 1 << self.depth):
            part = parts.pop(node)
            right = np.zeros(len(part), dtype=bool)
            if x[part].size:
                self.at[node] = np.argmax(x[part].std(axis=0))
                values = x[part, self.at[node]]
                self.value[node] = np.median(values)
                right = values > self.value[node]
            parts[2 * node], parts[2 * node + 1] = part[~right], part[right]
        self.width = x.shape[1]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        x = vectors.fitted(x, max(1, self.width))
        node, rows = np.ones(len(x), dtype=np.int64), np.arange(len(x))
        for _ in range(self.depth):
            node = 2 * node + (x[rows, self.at[node]] > self.value[node])
        return node - (1 << self.depth)


class Best:
    """The ``k`` best answers, by score and then id, to each of several queries; each query has a least one from before."""

    def __init__(self, k: int, low: np.ndarray, low_id: np.ndarray):
        self.k = k
        self.low, self.low_id = low.copy(), low_id.copy()
        self.query, self.score, self.id = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Take in answers, and raise the least useful one of queries that have ``k``."""
        touched = np.zeros(len(self.low), dtype=bool)
        touched[query] = True
        old = touched[self.query]
        rest = [p[~old] for p in (self.query, self.score, self.id)]
        query, score, ids = (np.concatenate([p[old], new]) for p, new in ((self.query, query), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        first = np.flatnonzero(np.diff(query, prepend=-1))
        rank = np.arange(len(query)) - np.repeat(first, np.diff(first, append=len(query)))
        kept, last = rank < self.k, rank == self.k - 1
        self.low[query[last]], self.low_id[query[last]] = score[last], ids[last]
        self.query, self.score, self.id = (np.concatenate([p, new[kept]]) for p, new in zip(rest, (query, score, ids)))


class Tree:
    """A KD-tree over the rows of a shard; node 1 is the root, 2i and 2i + 1 are the children of i."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, leaf: int = LEAF):
        self.depth = max(0, int(np.ceil(np.log2(max(1, len(ids)) / leaf))))
        parts = [np.arange(len(ids))]
        for _ in range(self.depth):
            parts = [half for part in parts for half in self._halves(part, x)]
        order = np.concatenate(parts)
        self.cuts = np.cumsum([0] + [len(p) for p in parts])
        self.ids, self.x = ids[order], x[order]
        los = np.array([x[p].min(axis=0) for p in parts])
        his = np.array([x[p].max(axis=0) for p in parts])
        low_ids = np.array([ids[p].min() for p in parts])
        # From the leaves upwards, one array for each level.
        self.levels = [(los, his, low_ids)]
        for _ in range(self.depth):
            lo, hi, low_id = self.levels[0]
            self.levels.insert(0, (np.minimum(lo[::2], lo[1::2]), np.maximum(hi[::2], hi[1::2]), np.minimum(low_id[::2], low_id[1::2])))

    @staticmethod
    def _halves(part: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = x[part]
        widest = np.argmax(own.max(axis=0) - own.min(axis=0)) if x.shape[1] else 0
        middle = len(part) // 2
        order = np.argpartition(own[:, widest], middle) if x.shape[1] else np.arange(len(part))
        return part[order[:middle]], part[order[middle:]]

    def _reached(self, q: np.ndarray, best: Best) -> np.ndarray:
        """Bound of each query's score in each leaf; the least long where the way down was cut off."""
        reach = np.ones((len(q), 1), dtype=bool)
        for lo, hi, low_id in self.levels:
            if reach.shape[1] < len(lo):
                reach = np.repeat(reach, 2, axis=1)
            nodes = np.flatnonzero(reach.any(axis=0))
            bounds = np.full(reach.shape, LOWEST)
            bounds[:, nodes] = box_bounds(q, lo[nodes], hi[nodes])
            low, tied = best.low[:, None], low_id[None, :] <= best.low_id[:, None]
            reach &= (bounds > low) | ((bounds == low) & tied)
        return np.where(reach, bounds, LOWEST)

    def search(self, q: np.ndarray, own: np.ndarray, best: Best) -> None:
        """Add to ``best`` the answers to the queries ``q``, none of them a row of the query's id in ``own``."""
        q = vectors.fitted(q, self.x.shape[1])
        bounds = self._reached(q, best)
        order = np.argsort(-bounds, axis=1, kind="stable")
        active = np.arange(len(q))
        for step in range(order.shape[1]):
            leaf = order[active, step]
            bound = bounds[active, leaf]
            low_id = self.levels[-1][2][leaf]
            tied = (bound == best.low[active]) & (low_id <= best.low_id[active])
            # A leaf that is only out because of its ids does not end the search: later ones may have the same bound.
            visit = (bound > best.low[active]) | tied
            going = (bound > LOWEST) & (bound >= best.low[active])
            found = [self._leaf(q, own, best, at, active[visit & (leaf == at)]) for at in np.unique(leaf[visit]).tolist()]
            if found:
                best.add(*(np.concatenate(part) for part in zip(*found)))
            active = active[going]
            if not len(active):
                break

    def _leaf(self, q, own, best: Best, leaf: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = self.cuts[leaf], self.cuts[leaf + 1]
        scores, ids = vectors.dots(q[rows], self.x[a:b]), self.ids[None, a:b]
        low, low_id = best.low[rows, None], best.low_id[rows, None]
        hit = ((scores > low) | ((scores == low) & (ids <= low_id))) & (ids != own[rows, None])
        i, j = np.nonzero(hit)
        return rows[i], scores[i, j], self.ids[a:b][j]


def box_bounds(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The greatest inner product that each row of ``q`` can have inside each box."""
    width = lo.shape[1]
    q = vectors.fitted(q, width)
    ends = np.concatenate([lo, hi])
    if not vectors.small(np.concatenate([q, q], axis=1), np.concatenate([ends, ends], axis=1)):
        return np.full((len(q), len(lo)), HIGHEST)
    return (np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T).astype(np.int64)


def _dealing(rows: DataFrame, scale: int, block: int) -> vectors.Dealing:
    size = rows.agg(F.count("*").alias("n"), F.sum(F.size("embedding")).alias("components")).first()
    cells = vectors.cells_wanted(rows, size.n, size.components or 0, block)
    share = min(1.0, SAMPLE / max(1, size.n))
    drawn = rows.filter(F.pmod(F.xxhash64("id", F.lit(13)), F.lit(1 << 20)) < int(share * (1 << 20)))
    sample = drawn.select("embedding").toArrow().column("embedding")
    splits = Splits(vectors.matrix(sample, scale), cells)
    return vectors.Dealing(splits, lambda x: x, scale)


def top_k(rows: DataFrame, asking: Column, k: int = 20, scale: int = SCALE, block: int = vectors.BLOCK, leaf: int = LEAF) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` best rows for each row at which ``asking``, a condition on vec_id, holds.

    ``rows`` has vec_id and embedding.
    """
    asking_ids = vectors.usable(rows.filter(asking))
    rows = vectors.usable(rows)
    dealing = _dealing(rows, scale, block)
    cells = vectors.cells_of(rows, dealing, block)
    placed = vectors.with_blocks(rows, dealing, cells)
    queries = asking_ids.groupBy("id").agg(F.min("embedding").alias("embedding"))
    queries = saved(vectors.with_blocks(queries.select("id", F.lit(0).cast("long").alias("label"), "embedding"), dealing, cells))

    def index(table: pa.Table) -> Tree:
        return Tree(table.column("id").to_numpy(), vectors.matrix(table.column("embedding"), scale), leaf)

    def answer(tree: Tree, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
        ids = batch.column("id").to_numpy()
        low, low_id = (batch.column(c).flatten().to_numpy() for c in ("low", "low_id"))
        found = Best(k, low, low_id)
        tree.search(vectors.matrix(batch.column("embedding"), scale), ids, found)
        yield ids[found.query], np.zeros(len(found.query), dtype=np.int32), found.id, found.score

    none = F.lit(None).cast("array<long>")
    first = queries.withColumn("low", F.array(F.lit(LOWEST))).withColumn("low_id", F.array(F.lit(HIGHEST))).withColumn("high", none)
    near = saved(vectors.answers(placed, first, cells.blocks, index, answer))
    least = vectors.best(near, k).filter(F.col("rank") == k).select(F.col("ask").alias("id"), "score", F.col("id").alias("last"))
    known = queries.join(least, "id", "left").select(
        "id", "label", "embedding", "block",
        F.array(F.coalesce("score", F.lit(LOWEST))).alias("low"), F.array(F.coalesce("last", F.lit(HIGHEST))).alias("low_id"),
    )
    far = vectors.answers(placed, _others(known, cells, scale).withColumn("high", none), cells.blocks, index, answer)
    found = vectors.best(near.union(far), k)
    return found.select(F.col("ask").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")


def _others(queries: DataFrame, cells: vectors.Cells, scale: int) -> DataFrame:
    """``queries`` once for each block, but their own, whose box may hold an answer."""
    known = queries.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bounds = box_bounds(vectors.matrix(batch.column("embedding"), scale), known.value.lo, known.value.hi)
                wanted = bounds >= batch.column("low").flatten().to_numpy()[:, None]
                blocks = [known.value.blocks_of(w, own) for w, own in zip(wanted, batch.column("block").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(blocks, pa.list_(pa.int64()))], [*batch.schema.names, "blocks"]
                )

    kind = queries.schema["embedding"].dataType.simpleString()
    routed = queries.mapInArrow(
        run, f"id long, label long, embedding {kind}, block long, low array<long>, low_id array<long>, blocks array<long>"
    )
    return routed.select("id", "label", "embedding", "low", "low_id", F.explode("blocks").alias("block"))
