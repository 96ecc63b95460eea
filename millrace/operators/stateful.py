"""Dedup and threshold stages on batch frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import json_text as J
from millrace.operators.hold import hold, hold_sorted
from millrace.operators.runs import hold_runs, without_repeated_numbers
from millrace.operators.slices import MAX_ROWS, SlicePlan, bounded_join, plan_slices
from millrace.session import checkpointed


def payload_key(payload: Column) -> Column:
    """Identity of a payload: a 256-bit digest, safe to tell all payloads apart."""
    return F.unhex(F.sha2(F.coalesce(payload, F.lit("")), 256))


def dedup(df: DataFrame, ttl_ms: int, max_rows: int = MAX_ROWS) -> DataFrame:
    """Drop events whose payload was kept in the same stream up to ``ttl_ms`` ago.

    A dropped duplicate does not prolong the time; a kept event starts it anew.
    """
    if ttl_ms < 0:
        return df
    keyed = df.withColumn("_key", payload_key(F.col("payload")))
    return hold_repeats(keyed, F.lit(ttl_ms), plan_slices(df, max_rows)).drop("_key")


def hold_repeats(
    df: DataFrame,
    ttl_ms: Column,
    plan: SlicePlan | None,
    scope=("stream_id",),
    mark: str | None = None,
    subject: Column | None = None,
) -> DataFrame:
    """Dedup of a frame that carries ``_key``; only rows that are ``subject`` take part."""
    keys = [*scope, "_key"]
    if plan is not None:
        # A heavy stream is no trouble here as long as none of its payloads is heavy.
        hot, hot_rows = hot_keys(df, keys, plan)
        plan = plan if hot_rows else None
        if hot_rows:
            df = bounded_join(df, hot.withColumn("_hot", F.lit(True)), keys, hot_rows)
    if plan is None:
        return hold_runs(df, keys, ttl_ms.cast("long"), mark, F.lit(True) if subject is None else subject)
    time = F.col("timestamp").cast("double")
    timed = df.withColumn("_value", time if subject is None else F.when(subject, time))
    timed = timed.withColumn("_delta", (ttl_ms + 1).cast("double"))
    return hold(timed, keys, plan, mark).drop("_value", "_delta")


def hot_keys(df: DataFrame, keys: list[str], plan: SlicePlan) -> tuple[DataFrame, int]:
    """Keys with more rows than a slice holds, and their number, which ``plan`` bounds."""
    heavy = bounded_join(df, plan.streams.select("stream_id"), ["stream_id"], plan.stream_rows, "left_semi")
    counts = heavy.groupBy(*keys).agg(F.count("*").alias("_n"))
    hot = checkpointed(counts.filter(F.col("_n") > plan.rows).select(*keys))
    return hot, hot.count()


def threshold(df: DataFrame, path: str, delta: float, max_rows: int = MAX_ROWS) -> DataFrame:
    """Drop events whose number at ``path`` moved less than ``delta`` since the last kept one."""
    valued = (
        J.with_document(df)
        .withColumn("_found", J.extract(F.col("_doc"), path))
        .withColumn("_number", J.number(F.col("_found")))
        .drop("_doc", "_found")
    )
    delta = F.lit(float(delta))
    return hold_small_changes(valued, delta, plan_slices(df, max_rows)).drop("_number")


def hold_small_changes(
    df: DataFrame,
    delta: Column,
    plan: SlicePlan | None,
    scope=("stream_id",),
    mark: str | None = None,
    subject: Column | None = None,
) -> DataFrame:
    """Threshold of a frame that carries ``_number``; rows with a NULL number pass."""
    subject = F.lit(True) if subject is None else subject
    valued = df.withColumn("_value", F.when(subject & delta.isNotNull(), F.col("_number")))
    valued = valued.withColumn("_delta", delta.cast("double"))
    if plan is None and mark is None:
        # Sorted once, for the JVM's part and for the rule itself.
        return hold_sorted(without_repeated_numbers(valued, list(scope)), list(scope)).drop("_value", "_delta")
    return hold(valued, list(scope), plan, mark).drop("_value", "_delta")
