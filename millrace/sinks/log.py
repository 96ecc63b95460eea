"""What a durable log does with its messages: routing, retention, replay."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.slices import bounded_join
from millrace.session import checkpointed

# How long a log keeps events unless told otherwise.
DEFAULT_MAX_AGE_MS = 72 * 3_600_000

HOUR_MS = 3_600_000


def subject_regex(pattern: str) -> str:
    """Regular expression of a subject pattern.

    ``*`` stands for one token, a final ``>`` for one or more.
    """
    tokens = pattern.split(".")
    parts = []
    for place, token in enumerate(tokens):
        if token == ">" and place == len(tokens) - 1:
            parts.append(r"[^.]+(\.[^.]+)*")
        else:
            parts.append(r"[^.]+" if token == "*" else re.escape(token))
    return r"\A" + r"\.".join(parts) + r"\z"


def captured_by(patterns: list[str], topic="topic") -> Column:
    """Whether any of the patterns captures the topic."""
    return reduce(Column.__or__, (F.col(topic).rlike(subject_regex(p)) for p in patterns), F.lit(False))


def routed(messages: DataFrame, logs: dict[str, list[str]]) -> DataFrame:
    """Add ``log``, the log whose patterns capture the topic; NULL when none does.

    A subject belongs to one log, so the first match decides.
    """
    choice = reduce(
        lambda chosen, item: F.coalesce(chosen, F.when(captured_by(item[1]), F.lit(item[0]))),
        logs.items(),
        F.lit(None).cast("string"),
    )
    return messages.withColumn("log", choice)


def unrouted(messages: DataFrame, logs: dict[str, list[str]]) -> DataFrame:
    """The messages that no log captures, to be set aside."""
    return routed(messages, logs).filter("log is null").drop("log")


def keep_young(messages: DataFrame, now_ms: int, max_age_ms: int = DEFAULT_MAX_AGE_MS) -> DataFrame:
    """Drop messages older than the age limit; a limit of 0 keeps all. Of a log, older days are not read."""
    if not max_age_ms:
        return messages
    oldest = now_ms - max_age_ms
    young = messages.filter(F.col("timestamp") >= oldest)
    if "day" not in messages.columns:
        return young
    return young.filter(F.col("day") >= F.to_date(F.timestamp_millis(F.lit(oldest))))


def keep_newest(
    messages: DataFrame, max_bytes: int, size: Column | None = None, log: str = "log"
) -> DataFrame:
    """Per log, keep the newest messages whose sizes add up to ``max_bytes`` at most.

    Hours are summed first. Only the hour in which the limit is reached is
    looked at by millisecond, and only that millisecond by message, so no task
    ever orders the messages of a whole log. A limit of 0 keeps all.
    """
    if not max_bytes:
        return messages
    size = F.octet_length("message") if size is None else size
    sized = messages.withColumns(
        {"_bytes": size.cast("long"), "_hour": F.floor(F.col("timestamp") / HOUR_MS)}
    )
    # Both tables of edges hold one row per log at most.
    hours = sized.groupBy(log, "_hour").agg(F.sum("_bytes").alias("_sum"), F.lit(0).alias("_newer"))
    hours = checkpointed(edge_of(hours, log, "_hour", max_bytes))
    in_hour = bounded_join(sized, hours, [log, "_hour"], hours.count(), "inner")
    times = in_hour.groupBy(log, "timestamp", "_newer").agg(F.sum("_bytes").alias("_sum"))
    times = checkpointed(edge_of(times, log, "timestamp", max_bytes).withColumnRenamed("timestamp", "_edge"))
    rows = bounded_join(sized, times, [log], times.count())
    newest = Window.partitionBy(log).orderBy(F.desc("seq"), F.desc("stream_id"))
    last = (
        rows.filter("timestamp = _edge")
        .withColumn("_upto", F.col("_newer") + F.sum("_bytes").over(newest))
        .filter(F.col("_upto") <= max_bytes)
    )
    names = messages.columns
    whole = rows.filter("_edge is null or timestamp > _edge")
    return whole.select(names).unionByName(last.select(names))


def edge_of(sums: DataFrame, log: str, time: str, limit: int) -> DataFrame:
    """Per log, the newest ``time`` whose sum goes over the limit, with the bytes newer than it."""
    newer = Window.partitionBy(log).orderBy(F.desc(time)).rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("_sum").over(newer), F.lit(0)) + F.col("_newer")
    return (
        sums.withColumn("_ahead", ahead)
        .filter((F.col("_ahead") <= limit) & (F.col("_ahead") + F.col("_sum") > limit))
        .select(log, time, F.col("_ahead").alias("_newer"))
    )


def replay(messages: DataFrame, pattern: str) -> DataFrame:
    """Messages whose topic matches, in publish order. Of a log, only what the first token leaves is read."""
    first = pattern.split(".")[0]
    if "topic_root" in messages.columns and first not in ("*", ">"):
        messages = messages.filter(F.col("topic_root") == first)
    return messages.filter(captured_by([pattern])).orderBy("timestamp", "seq", "stream_id")
