"""Hard negatives by coordinate pruning in buckets of vectors of like length.

For an anchor, its positives are the rows of its label with the greatest inner products; for each
positive, its hard negatives are the best rows of other labels whose score lies between two
percentages of the positive's. Components become whole numbers, floor(scale * x), so scores
are exact.

Vectors are dealt into buckets by length, at quantiles of the lengths of all rows, and large
buckets into blocks (``vectors``). A block keeps, for each coordinate, the list of its
vectors scaled to length 1, sorted by that coordinate. An answer of score ``low`` or more in a bucket
whose longest vector has length l needs a cosine of low / (|anchor| l) with the anchor. Buckets
where that is above 1 are not visited. In the others the cosine leaves a feasible range for each
coordinate; for the FOCUS largest coordinates of the anchor the sorted lists give the
positions of that range, and only vectors inside all of them are verified with whole numbers.

Positives and then negatives are first looked for in the anchor's own block; the least answer
found there goes along to the other blocks, whose ranges it narrows.

Defined results: rows with a null id or label, a null vector or a null or non-finite component
take no part. Vectors of different lengths are compared over their shared leading components. Ties go
to the smaller id. Rows that share an anchor's id are never its positives; among anchors that share
an id the row least in (label, vector) asks for all. Equal rows are rows each and may appear several
times. An anchor without positives, or a positive without negatives in its range, gives no row, nor
does a positive of negative score, whose range is empty. Empty tables give an empty result. Whole
numbers beyond 10^15 count as 10^15. Other columns do not matter.
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

SCALE = 256
#: Coordinates of an anchor whose feasible ranges are intersected.
FOCUS = 5
#: A block holds four tables as large as its vectors.
BLOCK = vectors.BLOCK // 2
#: Room for rounding in lengths and ranges; exact scores decide.
SLACK = 1e-9


def lengths(x: np.ndarray) -> np.ndarray:
    """Euclidean lengths."""
    return np.sqrt(np.einsum("ij,ij->i", x, x))


def feasible(unit: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """For each coordinate of a vector of length 1, the least and largest value in vectors of length 1 within ``cosine`` of it."""
    unit = np.clip(unit, -1.0, 1.0)
    spread = np.sqrt((1 - unit**2) * (1 - cosine**2))
    low = np.where(-unit >= cosine, -1.0, unit * cosine - spread)
    high = np.where(unit >= cosine, 1.0, unit * cosine + spread)
    return low - SLACK, high + SLACK


class Bucket:
    """The vectors of a block with a sorted list for each coordinate."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        own = lengths(x)
        self.longest = float(own.max(initial=0)) * (1 + SLACK)
        unit = x / np.where(own > 0, own, 1)[:, None]
        # By coordinate: rows in order, their values, and the place of each row.
        self.order = np.argsort(unit, axis=0, kind="stable").T.astype(np.int32)
        self.values = np.take_along_axis(unit.T, self.order, axis=1)
        self.place = np.empty_like(self.order)
        np.put_along_axis(self.place, self.order, np.arange(len(ids), dtype=np.int32)[None, :], axis=1)

    def candidates(self, q: np.ndarray, low: int, focus: int = FOCUS) -> np.ndarray:
        """Rows that may have a score of ``low`` or more with ``q``."""
        if low <= 0:
            return np.arange(len(self.ids))
        size = float(np.sqrt(q @ q))
        if size == 0 or not self.longest:
            return np.zeros(0, dtype=np.int64)
        cosine = low / (size * self.longest) * (1 - SLACK)
        if cosine > 1:
            return np.zeros(0, dtype=np.int64)
        unit = q / size
        at = np.argsort(-np.abs(unit))[:focus]
        least, most = feasible(unit[at], cosine)
        ranges = [
            (int(np.searchsorted(self.values[c], lo, "left")), int(np.searchsorted(self.values[c], hi, "right")), c)
            for c, lo, hi in zip(at.tolist(), least, most)
        ]
        ranges.sort(key=lambda r: r[1] - r[0])
        start, end, c = ranges[0]
        rows = self.order[c, start:end]
        for start, end, c in ranges[1:]:
            if end - start < len(self.ids):
                place = self.place[c, rows]
                rows = rows[(place >= start) & (place < end)]
        return rows

    def search(self, q, own: int, label: int, same: bool, lows, low_ids, highs, k: int, focus: int):
        """(slot, ids, scores) of the ``k`` best rows between the bounds of each slot, of the anchor's label or of others."""
        q = vectors.fitted(q[None, :], self.x.shape[1])[0]
        rows = self.candidates(q, int(lows.min()), focus)
        rows = rows[((self.labels[rows] == label) == same) & (self.ids[rows] != own)]
        if not len(rows):
            return
        scores, ids = vectors.dots(q[None, :], self.x[rows])[0], self.ids[rows]
        for slot, (low, low_id, high) in enumerate(zip(lows, low_ids, highs)):
            inside = np.flatnonzero(((scores > low) | ((scores == low) & (ids <= low_id))) & (scores <= high))
            if len(inside) > 4 * k:
                least = np.partition(scores[inside], len(inside) - k)[len(inside) - k]
                inside = inside[scores[inside] >= least]
            inside = inside[np.lexsort((ids[inside], -scores[inside]))][:k]
            if len(inside):
                yield slot, ids[inside], scores[inside]


class Mining:
    """The rows of a table in buckets, and searches among them."""

    def __init__(self, rows: DataFrame, scale: int, block: int, focus: int):
        self.scale, self.focus = scale, focus
        self.rows = vectors.usable(rows, "label")
        self.dealing = self._dealing(block)
        self.cells = vectors.cells_of(self.rows, self.dealing, block)
        self.placed = vectors.with_blocks(self.rows, self.dealing, self.cells)

    def _dealing(self, block: int) -> vectors.Dealing:
        """Buckets between quantiles of the lengths of all rows."""
        scale = self.scale

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = lengths(vectors.matrix(batch.column(0), scale))
                yield pa.RecordBatch.from_arrays([pa.array(own)], ["length"])

        size = self.rows.agg(F.count("*").alias("n"), F.sum(F.size("embedding")).alias("components")).first()
        wanted = vectors.cells_wanted(self.rows, size.n, size.components or 0, block)
        limits = np.zeros(0)
        if wanted > 1:
            shares = F.array(*(F.lit(i / wanted) for i in range(1, wanted)))
            found = self.rows.select("embedding").mapInArrow(run, "length double")
            limits = np.unique(found.agg(F.percentile_approx("length", shares, F.lit(20 * wanted))).first()[0])
        return vectors.Dealing(
            lambda x: np.searchsorted(limits, lengths(x), "left"), lambda x: lengths(x)[:, None], scale
        )

    def _answers(self, asks: DataFrame, same: bool, k: int) -> DataFrame:
        scale, focus = self.scale, self.focus

        def index(table: pa.Table) -> Bucket:
            ids, labels = (table.column(c).to_numpy() for c in ("id", "label"))
            return Bucket(ids, labels, vectors.matrix(table.column("embedding"), scale))

        def answer(bucket: Bucket, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
            q = vectors.matrix(batch.column("embedding"), scale)
            ids, labels = (batch.column(c).to_pylist() for c in ("id", "label"))
            bounds = zip(*(vectors.lists(batch.column(c)) for c in ("low", "low_id", "high")))
            for x, own, label, (low, low_id, high) in zip(q, ids, labels, bounds):
                for slot, found, scores in bucket.search(x, own, label, same, low, low_id, high, k, focus):
                    yield np.full(len(found), own), np.full(len(found), slot), found, scores

        return vectors.answers(self.placed, asks, self.cells.blocks, index, answer)

    def found(self, asks: DataFrame, same: bool, k: int) -> DataFrame:
        """ask, slot, id, score and rank of the ``k`` best rows for every slot of ``asks``.

        ``asks`` has id, label, embedding, block, and for each slot low and high.
        """
        asks = asks.withColumn("low_id", F.transform("low", lambda _: F.lit(HIGHEST)))
        near = saved(self._answers(asks, same, k))
        least = vectors.best(near, k).filter(F.col("rank") == k).groupBy("ask").agg(
            F.map_from_entries(F.collect_list(F.struct("slot", F.struct("score", "id").alias("v")))).alias("least")
        )
        known = asks.join(least.withColumnRenamed("ask", "id"), "id", "left")
        slots = F.sequence(F.lit(0), F.size("low") - 1)
        raised = F.transform(slots, lambda i: F.coalesce(F.try_element_at("least", i)["score"], F.element_at("low", i + 1)))
        ids = F.transform(slots, lambda i: F.coalesce(F.try_element_at("least", i)["id"], F.lit(HIGHEST)))
        known = known.select("id", "label", "embedding", "block", raised.alias("low"), ids.alias("low_id"), "high")
        far = self._answers(self._others(known), same, k)
        return vectors.best(near.union(far), k)

    def _others(self, asks: DataFrame) -> DataFrame:
        """``asks`` once for each block, but their own, whose vectors are long enough to hold an answer."""
        known, scale = asks.sparkSession.sparkContext.broadcast(self.cells), self.scale

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    sizes = lengths(vectors.matrix(batch.column("embedding"), scale))
                    low = np.array([own.min() for own in vectors.lists(batch.column("low"))], dtype=np.float64)
                    reach = sizes[:, None] * known.value.hi[None, :, 0] * (1 + 2 * SLACK)
                    wanted = (low <= 0)[:, None] | (reach >= low[:, None])
                    blocks = [known.value.blocks_of(w, own) for w, own in zip(wanted, batch.column("block").to_pylist())]
                    yield pa.RecordBatch.from_arrays(
                        [*batch.columns, pa.array(blocks, pa.list_(pa.int64()))], [*batch.schema.names, "blocks"]
                    )

        kind = asks.schema["embedding"].dataType.simpleString()
        routed = asks.mapInArrow(
            run,
            f"id long, label long, embedding {kind}, block long, low array<long>, low_id array<long>, "
            "high array<long>, blocks array<long>",
        )
        return routed.select("id", "label", "embedding", "low", "low_id", "high", F.explode("blocks").alias("block"))


def hard_negatives(
    rows: DataFrame,
    asking: Column,
    positives: int = 5,
    negatives: int = 5,
    least_percent: int = 80,
    most_percent: int = 100,
    scale: int = SCALE,
    block: int = BLOCK,
    focus: int = FOCUS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``rows`` has vec_id, embedding and label; the rows at which ``asking``, a condition on vec_id,
    holds are the anchors. Of a negative's score, a hundredfold lies between ``least_percent`` and
    ``most_percent`` times the positive's.
    """
    mining = Mining(rows, scale, block, focus)
    anchors = vectors.usable(rows.filter(asking), "label")
    anchors = anchors.groupBy("id").agg(F.min(F.struct("label", "embedding")).alias("row")).select("id", "row.label", "row.embedding")
    anchors = saved(vectors.with_blocks(anchors, mining.dealing, mining.cells))
    any_score = anchors.withColumn("low", F.array(F.lit(LOWEST))).withColumn("high", F.array(F.lit(HIGHEST)))
    near = saved(mining.found(any_score, True, positives).select("ask", "rank", "id", "score"))
    own = near.groupBy("ask").agg(F.array_sort(F.collect_list(F.struct("rank", F.col("id").alias("positive"), "score"))).alias("own"))
    own = own.select(F.col("ask").alias("id"), F.transform("own", lambda p: _range(p, least_percent, most_percent)).alias("own"))
    own = own.select("id", F.filter("own", lambda p: p["low"] <= p["high"]).alias("own")).filter(F.size("own") > 0)
    asks = anchors.join(own, "id").withColumn("low", F.col("own.low")).withColumn("high", F.col("own.high"))
    found = mining.found(asks, False, negatives).join(own.withColumnRenamed("id", "ask"), "ask")
    positive = F.col("own")[F.col("slot")]
    return found.select(
        F.col("ask").alias("anchor_id"),
        positive["positive"].alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        positive["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


def _range(positive: Column, least_percent: int, most_percent: int) -> Column:
    """A positive with the least and greatest score of its negatives."""
    score = positive["score"].cast("decimal(20,0)")
    low, high = F.ceil(score * least_percent / 100), F.floor(score * most_percent / 100)
    ends = (F.greatest(F.least(v.cast("decimal(38,0)"), F.lit(HIGHEST)), F.lit(LOWEST)).cast("long") for v in (low, high))
    return F.struct(positive["positive"].alias("positive"), positive["score"].alias("score"), *(e.alias(n) for e, n in zip(ends, ("low", "high"))))
