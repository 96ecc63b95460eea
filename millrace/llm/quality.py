"""Quality by the perplexity of an interpolated modified Kneser-Ney model.

The model predicts each byte of a text, and its end, from the ORDER - 1 bytes before.
It is trained on trusted text: all documents whose labels say quality 1. Counts are
pre-aggregated in the tasks that read the text and summed in shards by n-gram; the counts of
lower orders, discounts and back-off weights follow from them by grouping; and joins of
the counts of all orders give the probability of every n-gram that any document holds. A
document's perplexity is the exponential of its mean loss per byte. Documents above the
SHARE quantile of the trusted documents of their language are not kept; for it, half of
the trusted documents are measured by a model of the other half.

The table of probabilities is counted. Up to BROADCAST_GRAMS it goes to the workers, which sum
up whole texts; a larger one is joined with the n-gram counts of the documents instead. Both
give the same sums.

Defined results: a null or empty text has no perplexity and is kept; a null language is one of
its own; languages with fewer than LEAST such documents take the quantile of all; without
trusted text nothing is measured and all is kept. Of labels that contradict each other the lowest
counts; rows that share a doc_id are measured each by its text. An empty table gives an empty
result. Columns other than those named do not matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import pick, saved, text_or_empty

ORDER = 5
#: Least sum of both losses on labelled documents that the model had not seen: README has the figures.
SHARE = 0.95
LEAST = 20
#: Trusted ids that are broadcast, 8 bytes each; beyond, they are joined by a shuffle of the texts.
BROADCAST_IDS = 5_000_000
#: 12 bytes each, fewer as packed; more n-grams are joined instead of broadcast.
BROADCAST_GRAMS = 8_000_000
#: Distinct n-grams that a task holds before it passes its counts on.
HELD = 2_000_000
#: Bytes of text looked at together.
CHUNK = 2_000_000

#: Bytes that UTF-8 never has stand for the begin and the end of a text.
_BEGIN, _END = 0xFF, 0xFE
_MASKS = [0] + [(1 << 8 * k) - 1 for k in range(1, 9)]


def _grams(text: bytes, order: int) -> np.ndarray:
    """The n-gram that ends at each byte of a text and at its end, as a number."""
    raw = np.frombuffer(bytes([_BEGIN] * (order - 1)) + text + bytes([_END]), dtype=np.uint8).astype(np.int64)
    n = len(text) + 1
    out = np.zeros(n, dtype=np.int64)
    for k in range(order):
        out = (out << 8) | raw[k : k + n]
    return out


def _chunks(texts: Iterator[str], order: int) -> Iterator[np.ndarray]:
    """N-grams of many texts together."""
    held, size = [], 0
    for text in texts:
        if text:
            held.append(_grams(text.encode("utf-8"), order))
            size += len(held[-1])
            if size >= CHUNK:
                yield np.concatenate(held)
                held, size = [], 0
    if held:
        yield np.concatenate(held)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams, where = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return grams, np.bincount(where, np.concatenate([n for _, n in parts]), len(grams)).astype(np.int64)


def gram_counts(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram`` and ``n``, its count in the column ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, np.ndarray] | None = None
        for chunk in _chunks((text for batch in batches for text in batch.column(0).to_pylist()), order):
            own = np.unique(chunk, return_counts=True)
            held = _merged([held, own]) if held else own
            if len(held[0]) > HELD:
                yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1])], ["gram", "n"])
                held = None
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1])], ["gram", "n"])

    return texts.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """The three discounts of modified Kneser-Ney, from how many n-grams have counts 1 to 4."""
    c = counts.agg(*(F.count_if(F.col("n") == k).alias(f"n{k}") for k in (1, 2, 3, 4))).first()
    if not all(c):
        return 0.5, 0.75, 0.9
    y = c.n1 / (c.n1 + 2 * c.n2)
    return tuple(min(max(k - (k + 1) * y * c[k] / c[k - 1], 0.01), k) for k in (1, 2, 3))


def _order_tables(counts: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Of one order: gram and its discounted share of its context; context and the weight of the lower order."""
    d = discounts(counts)
    off = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
    tagged = counts.withColumn("context", F.shiftright("gram", 8))
    sums = tagged.groupBy("context").agg(F.sum("n").alias("total"), F.sum(off).alias("taken"))
    shares = tagged.join(sums, "context").select(
        F.col("gram").alias(f"g{k}"), (F.greatest(F.col("n") - off, F.lit(0.0)) / F.col("total")).alias(f"share{k}")
    )
    return shares, sums.select(F.col("context").alias(f"c{k}"), (F.col("taken") / F.col("total")).alias(f"weight{k}"))


def gram_scores(counts: DataFrame, wanted: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram`` and ``loss``, minus the log of its probability, for the n-grams of ``wanted`` (gram).

    Below the highest order, an n-gram counts once for each byte that comes before it.
    """
    by_order = {order: counts}
    for k in range(order - 1, 0, -1):
        lower = by_order[k + 1].select(F.col("gram").bitwiseAND(_MASKS[k]).alias("gram"))
        by_order[k] = saved(lower.groupBy("gram").agg(F.count("*").alias("n")))
    scored = wanted.select("gram").withColumn("p", F.lit(1.0 / 256))
    for k in range(1, order + 1):
        shares, weights = _order_tables(by_order[k], k)
        scored = scored.withColumn(f"g{k}", F.col("gram").bitwiseAND(_MASKS[k])).withColumn(f"c{k}", F.shiftright(f"g{k}", 8))
        scored = scored.join(shares, f"g{k}", "left").join(weights, f"c{k}", "left")
        p = F.coalesce(f"share{k}", F.lit(0.0)) + F.coalesce(f"weight{k}", F.lit(1.0)) * F.col("p")
        scored = scored.select("gram", p.alias("p"))
    return scored.select("gram", (-F.log("p")).alias("loss"))


class Lookup:
    """Values of known numbers, found by hashing whole arrays at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(10, int(np.ceil(np.log2(max(1, len(keys)) * 2))))
        self.keys, self.values = np.full(1 << self.bits, -1, dtype=np.int64), np.zeros(1 << self.bits, dtype=np.float32)
        left, at = np.arange(len(keys)), self._home(keys)
        while len(left):
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[left[free]]  # of several the last stays
            won = self.keys[at] == keys[left]
            self.values[at[won]] = values[left[won]]
            left, at = left[~won], (at[~won] + 1) & ((1 << self.bits) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key; every key is known."""
        at = self._home(keys)
        wrong = np.flatnonzero(self.keys[at] != keys)
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & ((1 << self.bits) - 1)
            wrong = wrong[self.keys[at[wrong]] != keys[wrong]]
        return self.values[at]


def _packed(scores: DataFrame) -> list[tuple[bytes, bytes]]:
    """Pieces of sorted n-grams, as compressed steps, and their losses. One partition after the other passes the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(batch.column(0).to_numpy(), batch.column(1).to_numpy()) for batch in batches]
        if held:
            grams, losses = (np.concatenate(column) for column in zip(*held))
            order = np.argsort(grams)
            # Byte planes of the steps: the upper ones are nearly all zero.
            steps = np.diff(grams[order], prepend=0).view(np.uint8).reshape(-1, 8).T.tobytes()
            packed = [zlib.compress(steps, 1)], [losses[order].astype(np.float32).tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array(column, pa.binary()) for column in packed], ["grams", "losses"])

    pieces = scores.select("gram", "loss").mapInArrow(run, "grams binary, losses binary")
    return [(bytes(piece.grams), bytes(piece.losses)) for piece in pieces.toLocalIterator()]


def _unpacked(pieces: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    steps = [np.frombuffer(zlib.decompress(grams), np.uint8).reshape(8, -1).T for grams, _ in pieces]
    grams = [np.cumsum(np.ascontiguousarray(own).view(np.int64).ravel()) for own in steps]
    losses = [np.frombuffer(losses, np.float32) for _, losses in pieces]
    return np.concatenate([np.zeros(0, np.int64), *grams]), np.concatenate([np.zeros(0, np.float32), *losses])


def _losses_by_lookup(docs: DataFrame, scores: DataFrame, order: int) -> DataFrame:
    given = docs.sparkSession.sparkContext.broadcast(_packed(scores))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss = Lookup(*_unpacked(given.value))
        for batch in batches:
            sums = [
                sum(float(loss(c).sum(dtype=np.float64)) for c in _chunks(iter([text]), order))
                for text in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sums, pa.float64())], ["row", "bytes", "loss"])

    found = saved(docs.select("row", "text", "bytes").mapInArrow(run, "row long, bytes long, loss double"))
    # Written, so nothing needs the table again: the driver need not hold it beside the next one.
    given.destroy()
    return found


def _losses_by_join(docs: DataFrame, scores: DataFrame, order: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for chunk in _chunks(iter([text]), order):
                    grams, n = np.unique(chunk, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(grams), row)), pa.array(grams), pa.array(n)], ["row", "gram", "n"])

    counted = docs.select("row", "text").mapInArrow(run, "row long, gram long, n long").join(scores, "gram")
    sums = counted.groupBy("row").agg(F.sum(F.col("n") * F.col("loss").cast("float")).alias("loss"))
    # Equal rows were summed up together.
    equal = docs.groupBy("row").agg(F.first("bytes").alias("bytes"), F.count("*").alias("copies"))
    return equal.join(sums, "row", "left").select("row", "bytes", (F.col("loss") / F.col("copies")).alias("loss"))


def _row() -> Column:
    """One number for a document, alike for equal ones."""
    return F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text")


def _trusted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    good = pick(labels, "doc_id", "quality").dropna().groupBy("doc_id").agg(F.min("quality").alias("q"))
    good = saved(good.filter("q = 1").select("doc_id"))
    # The ids go to the texts; texts move only where there are too many ids.
    return docs.join(F.broadcast(good) if good.count() <= BROADCAST_IDS else good, "doc_id", "left_semi")


def _perplexities(docs: DataFrame, trusted: DataFrame, order: int, broadcast_grams: int) -> DataFrame | None:
    """row and perplexity of the texts of ``docs`` (row, text) that are not empty, by a model of ``trusted``; None without one."""
    counts = saved(gram_counts(trusted, order))
    if counts.isEmpty():
        return None
    scores = saved(gram_scores(counts, gram_counts(docs, order), order))
    texts = docs.select("row", "text", F.octet_length("text").cast("long").alias("bytes"))
    by = _losses_by_lookup if scores.count() <= broadcast_grams else _losses_by_join
    losses = by(texts, scores, order).filter("bytes > 0").dropDuplicates(["row"])
    return losses.select("row", F.exp(F.col("loss") / (F.col("bytes") + 1)).alias("perplexity"))


def _told(docs: DataFrame) -> DataFrame:
    return pick(docs, "doc_id", "text", "lang").withColumn("text", text_or_empty()).withColumn("row", _row())


def perplexities(docs: DataFrame, labels: DataFrame, order: int = ORDER, broadcast_grams: int = BROADCAST_GRAMS) -> DataFrame:
    """row, doc_id, lang and perplexity of every row of ``docs``; ``labels`` has doc_id and quality."""
    docs = _told(docs)
    found = _perplexities(docs, _trusted(docs, labels), order, broadcast_grams)
    narrow = docs.select("row", "doc_id", "lang")
    if found is None:
        return narrow.withColumn("perplexity", F.lit(None).cast("double"))
    return narrow.join(found, "row", "left")


def held_out(docs: DataFrame, labels: DataFrame, order: int = ORDER, broadcast_grams: int = BROADCAST_GRAMS) -> DataFrame:
    """lang and perplexity of half of the trusted documents, by a model of the others; by their own if there are none."""
    # By the text alone, so that equal texts are never on both sides.
    aside = F.pmod(F.xxhash64("text", F.lit(5)), F.lit(2)) == 0
    good = saved(_trusted(_told(docs), labels).withColumn("aside", aside))
    shown = good.filter("aside")
    found = _perplexities(shown, good.filter("not aside"), order, broadcast_grams)
    if found is None or shown.isEmpty():
        shown, found = good, _perplexities(good, good, order, broadcast_grams)
    if found is None:
        return good.select("lang", F.lit(None).cast("double").alias("perplexity")).limit(0)
    return shown.select("row", "lang").distinct().join(found, "row").select("lang", "perplexity")


def judged(docs: DataFrame, labels: DataFrame, share: float = SHARE, least: int = LEAST, **how) -> DataFrame:
    """doc_id, lang, perplexity, threshold and kept for every row of ``docs``."""
    measured = perplexities(docs, labels, **how)
    known = saved(held_out(docs, labels, **how))
    quantile = F.percentile_approx("perplexity", F.lit(share), F.lit(10_000))
    overall = known.agg(quantile).first()[0]
    own = known.groupBy("lang").agg(F.count("*").alias("seen"), quantile.alias("own")).filter(F.col("seen") >= least)
    own = own.select(F.col("lang").alias("__lang"), "own")
    found = measured.join(own, F.col("lang").eqNullSafe(F.col("__lang")), "left")
    threshold = F.coalesce("own", F.lit(overall).cast("double"))
    kept = F.coalesce(F.col("perplexity") <= threshold, F.lit(True))
    return found.select("doc_id", "lang", "perplexity", threshold.alias("threshold"), kept.alias("kept"))
