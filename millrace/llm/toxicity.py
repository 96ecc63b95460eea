"""Toxicity by cumulative-link ordinal regression.

A text is a sparse vector of the words and word beginnings that tell toxic texts from
others, each with 1 + log of its count. One weight vector w serves all ordered grades
of severity, and each threshold b_k has P(grade >= k) = 1 / (1 + exp(b_k - w x)). The
expected severity is the sum of these over k = 1, 2, ... A text is rejected where
P(grade >= 1) reaches a half. The fit maximises the likelihood of the grades, whose
probabilities are differences of neighbouring links; the gaps between thresholds are
exponentials, so they stay in order.

The model is fitted on SAMPLE labelled documents at most, those with the smallest
hashes of doc_id, equal texts once. Grades above zero come from labels of two values
by ``graded``; labels with more values are grades as they are.

Defined results: a null or empty text has no features and the severity of the
thresholds alone; labels without doc_id or grade are left out, of repeated labels the
highest counts; without a toxic or without a clean example nothing can be told apart
and the severity is zero. Rows that share a doc_id are scored each for itself. An
empty table gives an empty result. Columns other than those named do not matter.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bpe import Remembered
from millrace.llm.common import apart, pick, saved, text_or_empty

#: Labelled documents that the model is fitted on, at most.
SAMPLE = 20_000
#: Parameters of the model: features, those that tell the most toxic examples apart, and how many toxic examples must have one, as a number and as a share.
FEATURES = 4_096
SEEN = 4
SEEN_SHARE = 0.005
#: How much more often, by share of texts, a feature must be in toxic examples.
RATIO = 20.0
#: Grade 1 begins at one telling word, grade 2 at the second number, and so on.
GRADES = (1, 3, 6)
#: Lengths of word beginnings.
BEGINNINGS = (3, 4, 5, 6)
#: Longer words are known by a digest of all their letters.
LONGEST = 64
PENALTY = 1e-3
STEPS = 400

_WORDS = re.compile(r"[^\W_]+").findall


def features(word: str) -> list[str]:
    """The word and its beginnings, which end in a sign that no word has."""
    whole = word if len(word) <= LONGEST else hashlib.sha256(word.encode("utf-8", "surrogatepass")).hexdigest()
    return [whole, *(word[:n] + "~" for n in BEGINNINGS if len(word) > n)]


@dataclass
class Model:
    index: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def scorer(self):
        """A function from a text to its expected severity and P(grade >= 1)."""
        hits = Remembered(lambda word: [i for f in features(word) if (i := self.index.get(f)) is not None])

        def score(text: str) -> tuple[float, float]:
            if not len(self.thresholds):
                return 0.0, 0.0
            total = sum(self.weights[i] * (1 + math.log(n)) for i, n in counted(text, hits).items())
            above = 1 / (1 + np.exp(np.clip(self.thresholds - total, -500, 500)))
            return float(above.sum()), float(above[0])

        return score


def counted(text: str, hits) -> Counter:
    """How often each feature of the model is in a text."""
    return Counter(i for found in map(hits.__getitem__, _WORDS(text.lower())) if found for i in found)


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``text`` and ``grade`` of the sample."""
    grades = (
        pick(labels, "doc_id", "grade")
        .dropna()
        .groupBy("doc_id")
        .agg(F.max("grade").cast("int").alias("grade"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    texts = pick(docs, "doc_id", "text").join(F.broadcast(grades), "doc_id").filter("text <> ''")
    return texts.groupBy(F.sha2("text", 256).alias("same")).agg(F.first("text").alias("text"), F.max("grade").alias("grade"))


def telling(examples: DataFrame, most: int = FEATURES) -> dict[str, float]:
    """Features that toxic examples have far more often than others, with their log ratio."""
    totals = examples.agg(F.count_if(F.col("grade") > 0).alias("toxic"), F.count_if(F.col("grade") <= 0).alias("clean")).first()
    if not totals.toxic or not totals.clean:
        return {}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        of = Remembered(features)
        for batch in batches:
            for text, grade in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = set(_WORDS(text.lower()))
                seen[grade > 0].update({f for word in found for f in of[word]})
        both = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(both, pa.string()), *(pa.array([c[f] for f in both], pa.int64()) for c in seen)], ["f", "clean", "toxic"]
        )

    ratio = F.log(((F.col("toxic") + 0.1) / totals.toxic) / ((F.col("clean") + 0.1) / totals.clean))
    rows = (
        examples.select("text", "grade")
        .mapInArrow(count, "f string, clean long, toxic long")
        .groupBy("f")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .filter(F.col("toxic") >= max(SEEN, SEEN_SHARE * totals.toxic))
        .withColumn("ratio", ratio)
        .filter(F.col("ratio") >= math.log(RATIO))
        .orderBy((F.col("toxic") * F.col("ratio")).desc(), "f")
        .limit(most)
        .select("f", "ratio")
    )
    return {row.f: row.ratio for row in rows.collect()}


def graded(words: int) -> int:
    """Severity of a toxic text with so many telling words, one at least."""
    return max(1, sum(words >= least for least in GRADES))


def _loss_and_slopes(total: np.ndarray, y: np.ndarray, weight: np.ndarray, first: float, gaps: np.ndarray):
    """Minus the weighted log likelihood of grades ``y``; its slopes by ``total``, the first threshold and the logs of the gaps.

    With u = P(grade >= y) and v = P(grade >= y + 1), the probability of y is u - v = u (1 - v) (1 - exp(-gap)).
    """
    edges = np.concatenate([[-np.inf, first], first + np.cumsum(np.exp(gaps)), [np.inf]])
    lower, upper = edges[y], edges[y + 1]

    def link(x):
        return 1 / (1 + np.exp(-np.clip(x, -500, 500)))

    u, v = link(total - lower), link(total - upper)
    below, above = link(lower - total), link(upper - total)  # 1 - u and 1 - v without their rounding
    apart = -np.expm1(-np.maximum(upper - lower, 1e-12))
    loss = -(weight * (np.log(u) + np.log(above) + np.log(apart))).sum()
    grades = len(gaps) + 1
    at_lower = np.bincount(y, weight * below / (above * apart) * (y > 0), grades + 1)[1:]
    at_upper = np.bincount(y, weight * v / (u * apart) * (y < grades), grades + 1)[:-1]
    by_edge = at_lower - at_upper
    # A gap moves every threshold after it.
    by_gap = np.exp(gaps) * by_edge[::-1].cumsum()[::-1][1:]
    return loss, weight * (v - below), by_edge.sum(), by_gap


def _fit_matrix(rows: list[tuple[int, list[int], list[float]]], width: int, grades: int, penalty: float = PENALTY, steps: int = STEPS):
    """Weights and thresholds of the cumulative-link model, by gradient steps of adapted, shrinking size.

    Clean and toxic texts weigh the same as a whole: clean ones are many.
    """
    y = np.array([r[0] for r in rows]).clip(0)
    at = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    column = np.concatenate([np.asarray(r[1], dtype=np.int64) for r in rows])
    value = np.concatenate([np.asarray(r[2], dtype=float) for r in rows])
    toxic = max(1, int((y > 0).sum()))
    weight = np.where(y > 0, 0.5 / toxic, 0.5 / max(1, len(y) - toxic))
    found = np.concatenate([np.zeros(width), [0.5], np.zeros(grades - 1)])
    mean, square = np.zeros(len(found)), np.zeros(len(found))
    for step in range(1, steps + 1):
        w, first, gaps = found[:width], found[width], found[width + 1 :]
        _, by_total, by_first, by_gap = _loss_and_slopes(np.bincount(at, w[column] * value, len(rows)), y, weight, first, gaps)
        by_weight = np.bincount(column, by_total[at] * value, width) + penalty * w / width
        slope = np.concatenate([by_weight, [by_first], by_gap])
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        size = 0.1 * (1 - (step - 1) / steps)
        found = found - size * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-12)
    return found[:width], found[width] + np.concatenate([[0.0], np.cumsum(np.exp(found[width + 1 :]))])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model for ``labels`` (doc_id, grade), grade 0 for clean; two values are spread by ``graded``."""
    examples = saved(labelled(docs, labels, sample))
    ratios = telling(examples)
    index = {f: i for i, f in enumerate(sorted(ratios))}
    if not index:
        return Model({}, np.zeros(0), np.zeros(0))
    top = examples.agg(F.max("grade")).first()[0]

    def design(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = Remembered(lambda word: [i for f in features(word) if (i := index.get(f)) is not None])
        for batch in batches:
            made = []
            for text, grade in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = counted(text, hits)
                if grade > 0 and top == 1:
                    grade = graded(sum(bool(hits[word]) for word in _WORDS(text.lower())))
                made.append({"grade": grade, "columns": [*counts], "values": [1 + math.log(n) for n in counts.values()]})
            yield pa.RecordBatch.from_pylist(made, ROWS)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(r["grade"], r["columns"], r["values"]) for batch in batches for r in batch.to_pylist()]
        grades = max(r[0] for r in rows)
        w, b = _fit_matrix(rows, len(index), grades)
        yield pa.RecordBatch.from_pylist([{"weights": w.tolist(), "thresholds": b.tolist()}])

    rows = examples.select("text", "grade").mapInArrow(design, "grade int, columns array<int>, values array<double>")
    # All rows of the bounded sample, a few numbers each, in one task.
    fitted = rows.repartition(1).mapInArrow(solve, "weights array<double>, thresholds array<double>").first()
    return Model(index, np.array(fitted.weights), np.array(fitted.thresholds))


ROWS = pa.schema([("grade", pa.int32()), ("columns", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, severity (expected grade), p_toxic and kept (not rejected) for every row of ``docs``."""
    docs = pick(docs, "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    given = docs.sparkSession.sparkContext.broadcast((model.index, model.weights, model.thresholds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Model(*given.value).scorer()
        for batch in batches:
            found = [score(text or "") for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([f[i] for f in found], pa.float64()) for i in (0, 1))],
                ["doc_id", "severity", "p_toxic"],
            )

    return docs.mapInArrow(run, f"doc_id {kind}, severity double, p_toxic double").withColumn(
        "kept", F.col("p_toxic") < 0.5
    )


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns as they were."""
    given = docs.sparkSession.sparkContext.broadcast((model.index, model.weights, model.thresholds))

    @F.pandas_udf("boolean")
    def clean(texts):
        score = Model(*given.value).scorer()
        return texts.map(lambda text: score(text)[1] < 0.5)

    told, back = apart(docs, "text")
    return back(told.filter(clean(text_or_empty())))
