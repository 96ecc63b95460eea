"""Vectors in blocks, and questions that go to the blocks which may hold an answer.

The rows of a table (id, label, embedding) are dealt into cells by a rule of the operator, and a
cell that holds more than a block may is split by a hash of the id, so that no block grows with
the data, not even where a third of all vectors are equal. A task holds one block at a time,
indexes it, and lets the questions that were sent to it pass by in batches.

An answer is a row (ask, slot, id, score). What is known about the least useful answer goes along
with a question: ``low`` and ``low_id`` bound, for each of its slots, the score and, at that
score, the id of what is still looked for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import pick

#: Components of all vectors that a block holds, about.
BLOCK = 1 << 22
#: Cells are many enough for all cores where they keep this many rows each.
FEW = 2048
#: More vectors make fuller cells, which are split into blocks by a hash.
MAX_CELLS = 4096

#: Whole numbers beyond it count as it; all up to it are exact.
LARGEST = 1e15
HIGHEST = (1 << 63) - 1
LOWEST = -HIGHEST
_EXACT = float(1 << 53)
#: Vectors of very different lengths are kept in different cells: numbers of cells are (class, own number).
_CLASS = 1 << 20

ROWS = "id long, label long, embedding array<double>"
FOUND = "ask long, slot int, id long, score long"


def usable(rows: DataFrame, label: str | None = None) -> DataFrame:
    """id, label and embedding of the rows that take part.

    Those with a null id, a null vector, a null, NaN or infinite component, or (where a label is
    asked for) a null label do not.
    """
    given = pick(rows, "vec_id", "embedding", *([label] if label else []))
    own = F.col(label).cast("long") if label else F.lit(0).cast("long")
    given = given.select(F.col("vec_id").cast("long").alias("id"), own.alias("label"), "embedding")
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return given.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)


def matrix(lists: pa.Array | pa.ChunkedArray, scale: int) -> np.ndarray:
    """floor(scale * x) of each component, a vector in each row; zeros follow the end of the shorter ones."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    flat = np.clip(np.floor(np.clip(flat, -LARGEST, LARGEST) * scale), -LARGEST, LARGEST)
    width = int(lengths.max(initial=0))
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def fitted(x: np.ndarray, width: int) -> np.ndarray:
    """``x`` with ``width`` columns: cut, or with zeros added."""
    return x[:, :width] if x.shape[1] >= width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


def small(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether doubles hold all sums of products of ``a`` and ``b`` exactly."""
    return float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1] < _EXACT


def whole(x: np.ndarray) -> np.ndarray:
    """The same whole numbers without a bound on their size."""
    return x.astype(np.int64).astype(object)


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` and ``b``, of the same width; beyond 2^63 - 1 in size that."""
    if small(a, b):
        return (a @ b.T).astype(np.int64)
    return np.clip(whole(a) @ whole(b).T, LOWEST, HIGHEST).astype(np.int64)


def _mixed(ids: np.ndarray) -> np.ndarray:
    """Evenly spread numbers from 0 to 2^31 - 1 for ids."""
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(33)).astype(np.int64)


class Cells(NamedTuple):
    """What is known of the cells of a table; its size follows from MAX_CELLS, not from the rows."""

    names: np.ndarray
    #: The first block of each cell, and one past the last cell's.
    first: np.ndarray
    #: Least and largest value of each component of the summaries of the rows of each cell.
    lo: np.ndarray
    hi: np.ndarray

    @property
    def blocks(self) -> int:
        return int(self.first[-1])

    def block_of(self, names: np.ndarray, ids: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.names, names)
        return self.first[at] + _mixed(ids) % (self.first[at + 1] - self.first[at])

    def blocks_of(self, wanted: np.ndarray, but: int) -> list[int]:
        """Blocks of the cells at which ``wanted`` holds, without one."""
        found = [np.arange(self.first[i], self.first[i + 1]) for i in np.flatnonzero(wanted)]
        found = np.concatenate(found) if found else np.zeros(0, dtype=np.int64)
        return found[found != but].tolist()


class Dealing(NamedTuple):
    """How an operator deals vectors: the cell of each row of a matrix, and the values summarised by cell."""

    cell: Callable[[np.ndarray], np.ndarray]
    summary: Callable[[np.ndarray], np.ndarray]
    scale: int

    def of(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        lists = batch.column("embedding")
        x = matrix(lists, self.scale)
        lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        classes = np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64)
        return x, classes * _CLASS + self.cell(x)


def cells_wanted(rows: DataFrame, n: int, components: int, block: int) -> int:
    """How many cells fill blocks, or all cores where that leaves enough rows to each."""
    cores = 2 * rows.sparkSession.sparkContext.defaultParallelism
    return max(1, min(MAX_CELLS, max(-(-components // block), min(cores, n // FEW))))


def cells_of(rows: DataFrame, dealing: Dealing, block: int) -> Cells:
    """Count and summarise the cells of ``rows``; each task adds up its own ones before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list] = {}
        for batch in batches:
            x, cells = dealing.of(batch)
            summary = dealing.summary(x)
            for cell in np.unique(cells).tolist():
                own = summary[cells == cell]
                lo, hi, n = own.min(axis=0), own.max(axis=0), len(own)
                if cell in seen:
                    width = max(len(lo), len(seen[cell][0]))
                    lo, hi, old_lo, old_hi = (np.pad(v, (0, width - len(v))) for v in (lo, hi, *seen[cell][:2]))
                    lo, hi, n = np.minimum(lo, old_lo), np.maximum(hi, old_hi), n + seen[cell][2]
                seen[cell] = [lo, hi, n]
        if seen:
            lo, hi, n = ([part[i] for part in seen.values()] for i in range(3))
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen), pa.array(lo, pa.list_(pa.float64())), pa.array(hi, pa.list_(pa.float64())), pa.array(n)],
                ["cell", "lo", "hi", "n"],
            )

    parts = rows.mapInArrow(run, "cell long, lo array<double>, hi array<double>, n long")
    wide = parts.select("cell", "n", F.posexplode_outer(F.arrays_zip("lo", "hi")).alias("at", "v"))
    # A part whose vectors are all shorter has no value at ``at``: its zero counts.
    found = wide.groupBy("cell", "at").agg(
        F.min("v.lo").alias("lo"), F.max("v.hi").alias("hi"), F.sum("n").alias("n")
    ).collect()
    names = np.array(sorted({r.cell for r in found}), dtype=np.int64)
    width = max((r["at"] + 1 for r in found if r["at"] is not None), default=0)
    lo, hi, n = np.zeros((len(names), width)), np.zeros((len(names), width)), np.zeros(len(names), dtype=np.int64)
    where = {name: i for i, name in enumerate(names.tolist())}
    for r in found:
        if not r["at"]:  # each part has a row at 0, or one without a place if its vectors are empty
            n[where[r.cell]] += r.n
    for r in found:
        if r["at"] is not None:
            i, part = where[r.cell], r.n < n[where[r.cell]]
            lo[i, r["at"]], hi[i, r["at"]] = (min(r.lo, 0), max(r.hi, 0)) if part else (r.lo, r.hi)
    splits = np.maximum(1, -(-n * (1 << (names // _CLASS)) // block))
    return Cells(names, np.concatenate([[0], np.cumsum(splits)]), lo, hi)


def with_blocks(rows: DataFrame, dealing: Dealing, cells: Cells) -> DataFrame:
    """``rows`` (id, label, embedding) and ``block``, where each lies."""
    known = rows.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                names = dealing.of(batch)[1]
                block = known.value.block_of(names, batch.column("id").to_numpy())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(block)], [*batch.schema.names, "block"])

    kind = rows.schema["embedding"].dataType.simpleString()
    return rows.mapInArrow(run, f"id long, label long, embedding {kind}, block long")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
    """Neighbouring rows of one block and kind."""
    block, asks = batch.column("block").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero((block[1:] != block[:-1]) | (asks[1:] != asks[:-1])) + 1
    for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)]):
        if end > start:
            yield int(block[start]), bool(asks[start]), batch.slice(start, end - start)


def answers(
    placed: DataFrame,
    asks: DataFrame,
    blocks: int,
    index: Callable[[pa.Table], Any],
    answer: Callable[[Any, pa.RecordBatch], Iterator[tuple[np.ndarray, ...]]],
) -> DataFrame:
    """What the blocks of ``placed`` answer to ``asks`` (block, id, label, embedding, low, low_id, high).

    ``index`` prepares the rows of a block, ``answer`` gives columns of FOUND for a batch of questions.
    """
    none = F.lit(None).cast("array<long>")
    rows = placed.select("block", F.lit(False).alias("asks"), "id", "label", "embedding", *(none.alias(c) for c in ("low", "low_id", "high")))
    both = rows.unionByName(asks.select("block", F.lit(True).alias("asks"), "id", "label", "embedding", "low", "low_id", "high"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, indexed, current = [], None, None
        for batch in batches:
            for block, asking, part in _runs(batch):
                if block != current:
                    held, indexed, current = [], None, block
                if not asking:
                    held.append(part)
                    continue
                if indexed is None:
                    if not held:
                        continue
                    indexed, held = index(pa.Table.from_batches(held)), []
                for columns in answer(indexed, part):
                    arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))]
                    yield pa.RecordBatch.from_arrays(arrays, ["ask", "slot", "id", "score"])

    return both.repartition(max(1, blocks), "block").sortWithinPartitions("block", "asks").mapInArrow(run, FOUND)


def best(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` answers of each slot of a question, with their rank."""
    order = Window.partitionBy("ask", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def lists(column: pa.Array) -> list[np.ndarray]:
    """The number lists of a column, without copies."""
    ends, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
