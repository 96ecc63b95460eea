"""Exact dedup with a split of heavy hitters.

Texts are equal when they are identical after ``normalise``; of equal texts the
row with the largest doc_id stays. Digests that many rows share are found by
Misra-Gries summaries, one per partition, which are added up. The few that may
be heavy are counted exactly; the winners of the verified ones are broadcast,
and their rows are decided where they are read. All other digests, none of
which has more than a small share of the rows, are shuffled as usual.

Defined results: a null text counts as empty; a null doc_id is smaller than any
other; of rows that also share the doc_id, one stays, whichever it is. An empty
table gives an empty result. Columns other than doc_id and text do not matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from millrace.llm.common import apart, pick, saved, text_or_empty

#: Counters in the summary of a partition.
CAPACITY = 4096
#: A digest is heavy with one row in so many, and at least LEAST rows. With n rows
#: there are at most SHARE heavy digests, and that many winners are broadcast.
SHARE = 1024
LEAST = 64


def misra_gries(counts: Counter, capacity: int) -> Counter:
    """Cut ``counts`` to ``capacity`` counters.

    Taking the largest count left out from all keeps the error of every counter
    below rows / (capacity + 1), however often counts are added up and cut.
    """
    if len(counts) <= capacity:
        return counts
    level = sorted(counts.values(), reverse=True)[capacity]
    return Counter({key: n - level for key, n in counts.items() if n > level})


def _summaries(capacity: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for pair in batch.column(0).value_counts():
                counts[pair["values"].as_py()] += pair["counts"].as_py()
            counts = misra_gries(counts, capacity)
        if counts:
            yield pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], ["digest", "seen"]
            )

    return run


def digest(normalise: Callable[[Column], Column] | None = None) -> Column:
    """SHA-256 of the normalised text in UTF-8, as 32 bytes."""
    text = text_or_empty()
    return F.unhex(F.sha2((normalise(text) if normalise else text).cast("binary"), 256))


def heavy_digests(keyed: DataFrame, rows: int, capacity: int = CAPACITY, share: int = SHARE, least: int = LEAST) -> DataFrame:
    """Of ``keyed`` (digest, doc_id, row_tag): the digests of ``rows / share`` rows or more, each with its winner.

    A counter is short by at most ``rows / (capacity + 1)``, so a heavy digest cannot be
    missed, and the candidates number at most ``2 * share`` where capacity is twice the share or more.
    """
    bound = max(least, rows / share)
    candidates = (
        keyed.select("digest")
        .mapInArrow(_summaries(capacity), "digest binary, seen long")
        .groupBy("digest")
        .agg(F.sum("seen").alias("seen"))
        .filter(F.col("seen") >= bound - rows / (capacity + 1))
        .select("digest")
    )
    return (
        keyed.join(F.broadcast(candidates), "digest")
        .groupBy("digest")
        .agg(F.max(F.struct("doc_id", "row_tag")).alias("keep"), F.count("*").alias("group_size"))
        .filter(F.col("group_size") >= bound)
    )


def _keyed(docs: DataFrame, normalise=None) -> DataFrame:
    narrow = pick(docs, "doc_id", "text").select("doc_id", digest(normalise).alias("digest"))
    return saved(narrow.withColumn("row_tag", F.monotonically_increasing_id()))


def duplicate_groups(docs: DataFrame, normalise: Callable[[Column], Column] | None = None, **bounds) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (lowercase hex)."""
    keyed = _keyed(docs, normalise)
    winners = saved(heavy_digests(keyed, keyed.count(), **bounds))
    marked = keyed.join(F.broadcast(winners), "digest", "left")
    names = ("digest", "doc_id", "row_tag", "keep", "group_size")
    heavy = marked.filter(F.col("group_size").isNotNull()).select(*names)
    group = W.Window.partitionBy("digest")
    light = (
        marked.filter(F.col("group_size").isNull())
        .select("digest", "doc_id", "row_tag")
        .withColumn("keep", F.max(F.struct("doc_id", "row_tag")).over(group))
        .withColumn("group_size", F.count("*").over(group))
        .select(*names)
    )
    return heavy.union(light).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_tag") == F.col("keep.row_tag")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def dedup(docs: DataFrame, normalise: Callable[[Column], Column] | None = None, **bounds) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were.

    Losing rows of heavy digests go while the table is read. Of the rest, each task
    first cuts its rows to one per digest, then the digests are shuffled.
    """
    keyed = _keyed(docs, normalise)
    told, back = apart(docs, "doc_id", "text")
    winners = heavy_digests(keyed, keyed.count(), **bounds).select(
        F.col("digest").alias("__digest"), F.col("keep.doc_id").alias("__keep"), F.lit(True).alias("__heavy")
    )
    marked = told.withColumn("__digest", digest(normalise)).join(F.broadcast(saved(winners)), "__digest", "left")
    open_rows = marked.filter(F.col("__heavy").isNull() | F.col("doc_id").eqNullSafe(F.col("__keep")))
    newest = W.Window.partitionBy("__digest").orderBy(F.col("doc_id").desc_nulls_last())
    return back(open_rows.withColumn("__rank", F.row_number().over(newest)).filter("__rank = 1"))
