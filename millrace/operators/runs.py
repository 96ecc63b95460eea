"""What the JVM can settle of the ordered rules, so that little reaches Python.

Dedup: the events of a payload form runs, in which none comes more than the time-to-live after the
one before. The first of a run is kept whatever was before it, and what follows within the
time-to-live of that first one is dropped. Only later events of longer runs need the rule step by step.

Threshold: an event whose number equals that of the event before never passes, if numbers must
differ by more than nothing.

Both are windows over one sort by stream (and payload), which the step by step part then goes on
from without another shuffle. The sort is asked for by itself, as Spark leaves out a window whose
result it can do without.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.envelope import ORDER
from millrace.operators.slices import group_starts, sorted_by


def with_runs(df: DataFrame, keys: list[str], ttl_ms: Column, subject: Column) -> DataFrame:
    """Add ``_time``, an event's time where it takes part, and ``_run``, the time its run began."""
    so_far = Window.partitionBy(*keys).orderBy(*ORDER)
    timed = sorted_by(df, keys).withColumn("_time", F.when(subject, F.col("timestamp")))
    before = F.last("_time", ignorenulls=True).over(so_far.rowsBetween(Window.unboundedPreceding, -1))
    timed = timed.withColumn("_before", before)
    begins = F.col("_time").isNotNull() & (F.col("_before").isNull() | (F.col("_time") - F.col("_before") > ttl_ms))
    timed = timed.withColumn("_begin", F.when(begins, F.col("_time")))
    run = F.last("_begin", ignorenulls=True).over(so_far.rowsBetween(Window.unboundedPreceding, 0))
    return timed.withColumn("_run", run).drop("_before")


def unsettled(ttl_ms: Column) -> Column:
    """Whether an event lies in a run and more than the time-to-live after its beginning."""
    return F.col("_time").isNotNull() & (F.col("_time") - F.col("_run") > ttl_ms)


def hold_runs(df: DataFrame, keys: list[str], ttl_ms: Column, mark: str | None, subject: Column) -> DataFrame:
    """Dedup per ``keys``; rows that are not ``subject`` pass. With ``mark`` all rows stay, and it tells which passed."""
    names = df.columns
    subject = F.coalesce(subject, F.lit(False))
    timed = with_runs(df, keys, ttl_ms, subject).withColumn("_ttl", ttl_ms)
    open_ = unsettled(F.col("_ttl"))
    passed = F.col("_time").isNull() | F.col("_begin").isNotNull()
    settled = timed.filter(~open_)
    settled = settled.withColumn(mark, passed) if mark else settled.filter(passed)
    output = T.StructType([df.schema[name] for name in names])
    if mark:
        output = output.add(mark, T.BooleanType())
    # Rows of a run lie together and in order, as the windows have left them.
    stepped = timed.filter(open_).mapInArrow(_stepper([*keys, "_run"], names, mark), output)
    return settled.select(output.names).unionByName(stepped)


def _stepper(group: list[str], names: list[str], mark: str | None):
    def kernel(batches):
        key = last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            starts, key = group_starts(batch, group, key)
            passed = []
            columns = (batch.column(name).to_pylist() for name in ("_time", "_run", "_ttl"))
            for start, time, run, ttl in zip(starts.tolist(), *columns):
                last = run if start else last
                kept = time - last > ttl
                last = time if kept else last
                passed.append(kept)
            verdict = pa.array(passed, pa.bool_())
            rows = batch.select(names)
            yield rows.append_column(mark, verdict) if mark else rows.filter(verdict)

    return kernel


def without_repeated_numbers(df: DataFrame, keys: list[str]) -> DataFrame:
    """Drop events whose ``_value`` equals that of the event before, where ``_delta`` is above 0."""
    earlier = Window.partitionBy(*keys).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    before = F.last("_value", ignorenulls=True).over(earlier)
    value = F.col("_value")
    # A NaN or infinite number is left to the rule itself.
    finite = ~F.isnan(value) & (F.abs(value) < float("inf"))
    same = value.isNotNull() & finite & (value == F.col("_before")) & (F.col("_delta") > 0)
    return sorted_by(df, keys).withColumn("_before", before).filter(~F.coalesce(same, F.lit(False))).drop("_before")
