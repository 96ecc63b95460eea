"""Cutting heavy streams into slices that many tasks can work on.

Ordered operators need all events of a stream in order. A stream that holds a
large share of the data must not become one task, so a stream with more than
``max_rows`` events is cut by time, about every ``max_rows`` events. Only events
of the same millisecond always stay together. The operators carry their state
from slice to slice through small summaries.

Slices are found on counts per time unit. A heavy stream's units are as long as
it takes for a quarter of a slice on average, so there are few of them; units
that hold more than a whole slice are looked at by millisecond.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.envelope import ORDER
from millrace.session import checkpointed

# Events of one stream that a single task takes in order before the stream is cut.
MAX_ROWS = 2_000_000
# Slices to be had from all data together: with more events than this times
# ``max_rows``, slices grow instead, and what is broadcast about them does not.
MAX_SLICES = 20_000
UNITS_PER_SLICE = 4
# A side of a join is broadcast up to this many rows, all of them narrow.
BROADCAST_ROWS = 200_000

LOWEST = -(2**63)
HIGHEST = 2**63 - 1


@dataclass(frozen=True)
class SlicePlan:
    """Where heavy streams are cut."""

    rows: int  # events of a slice, about
    streams: DataFrame  # start and length of each heavy stream's time units
    stream_rows: int
    units: DataFrame  # each unit's first slice, and where slices begin in it
    unit_rows: int


def plan_slices(df: DataFrame, max_rows: int = MAX_ROWS) -> SlicePlan | None:
    """Find the heavy streams of ``df``; ``None`` when there are none.

    Only ``stream_id`` and ``timestamp`` are read, and the counts combine before
    the shuffle, so the cost is far below that of the pass that follows.
    """
    sizes = df.groupBy("stream_id").agg(
        F.count("*").alias("_n"), F.min("timestamp").alias("_start"), F.max("timestamp").alias("_end")
    )
    total, largest = sizes.agg(F.sum("_n"), F.max("_n")).first()
    if not total or largest <= max_rows:
        return None
    rows = max(max_rows, total // MAX_SLICES)
    per_row = (F.col("_end") - F.col("_start") + 1) / F.col("_n")
    unit = F.greatest(F.lit(1), F.floor(per_row * rows / UNITS_PER_SLICE))
    heavy = sizes.filter(F.col("_n") > rows).select("stream_id", "_start", unit.alias("_unit"))
    heavy = checkpointed(heavy)
    streams = heavy.count()
    if not streams:
        return None

    key = ["stream_id", "_at"]
    times = df.select("stream_id", "timestamp")
    times = _with_unit(bounded_join(times, heavy, ["stream_id"], streams, "inner"))
    units = times.groupBy(*key).agg(F.count("*").alias("_n"))
    units = checkpointed(units.withColumn("_ahead", _sum_before(["stream_id"], "_at")))
    full = units.filter(F.col("_n") > rows).drop("_n")
    found = units.filter(F.col("_n") <= rows).select(
        *key, F.floor(F.col("_ahead") / rows).alias("_base"), F.array(F.lit(LOWEST)).alias("_begins")
    )
    full_rows = full.count()
    if full_rows:
        inside = bounded_join(times, full, key, full_rows, "inner")
        instants = inside.groupBy(*key, "_ahead", "timestamp").agg(F.count("*").alias("_n"))
        place = F.floor((F.col("_ahead") + _sum_before(key, "timestamp")) / rows)
        begins = (
            instants.withColumn("_place", place)
            .groupBy(*key, "_place")
            .agg(F.min("timestamp").alias("_begin"))
        )
        cut = begins.groupBy(*key).agg(
            F.min("_place").alias("_base"), F.array_sort(F.collect_list("_begin")).alias("_begins")
        )
        found = checkpointed(found.unionByName(cut))
    return SlicePlan(rows, heavy, streams, found, units.count())


def _with_unit(df: DataFrame) -> DataFrame:
    at = F.floor((F.col("timestamp") - F.col("_start")) / F.col("_unit"))
    return df.withColumn("_at", at).drop("_start", "_unit")


def _sum_before(keys: list[str], order: str) -> Column:
    window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_n").over(window), F.lit(0))


def with_slices(df: DataFrame, plan: SlicePlan | None) -> DataFrame:
    """Add ``_slice``, increasing with time; ``LOWEST`` for streams left whole."""
    if plan is None:
        return df.withColumn("_slice", F.lit(LOWEST))
    begun = F.size(F.filter("_begins", lambda begin: begin <= F.col("timestamp")))
    joined = _with_unit(bounded_join(df, plan.streams, ["stream_id"], plan.stream_rows))
    joined = bounded_join(joined, plan.units, ["stream_id", "_at"], plan.unit_rows)
    slice_ = F.coalesce(F.col("_base") + begun, F.lit(LOWEST))
    return joined.withColumn("_slice", slice_).drop("_at", "_base", "_begins")


def sliced_only(df: DataFrame) -> DataFrame:
    """The events of streams that were cut."""
    return df.filter(F.col("_slice") > LOWEST)


def bounded_join(
    df: DataFrame, small: DataFrame, on: list[str], rows: int, how: str = "left"
) -> DataFrame:
    """Join that broadcasts ``small`` only when its counted size allows it."""
    return df.join(F.broadcast(small) if rows <= BROADCAST_ROWS else small, on, how)


def sorted_scan(df: DataFrame, group: list[str], order: list[str], kernel, schema) -> DataFrame:
    """Run ``kernel`` over Arrow batches in which each group is contiguous and ordered."""
    return sorted_by(df, group, order).mapInArrow(kernel, schema)


def sorted_by(df: DataFrame, group: list[str], order: list[str] = ORDER) -> DataFrame:
    """The rows of a group together in one partition, and in order."""
    return df.repartition(*group).sortWithinPartitions(*group, *order)


def group_starts(batch: pa.RecordBatch, names: list[str], previous: tuple | None):
    """Mark the rows where a group begins; also return the key of the last row.

    ``previous`` is the key of the last row of the batch before.
    """
    marks = np.zeros(batch.num_rows, dtype=bool)
    columns = [batch.column(name) for name in names]
    for column in columns:
        marks[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(
            zero_copy_only=False
        )
    marks[0] = tuple(column[0].as_py() for column in columns) != previous
    return marks, tuple(column[-1].as_py() for column in columns)
