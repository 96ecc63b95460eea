"""Logs with a manifest: bytes and events by log and hour, written with every append.

Retention by size looks up in the manifest in which hour the limit of a log is reached. It then
looks at that hour, finds the oldest message that stays, and reads what is newer. The days before,
which are partitions, are not touched, and of the day itself only narrow columns until the message is found.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators.slices import bounded_join
from millrace.session import checkpointed
from millrace.sinks.log import HOUR_MS, edge_of

DATA, MANIFEST = "data", "manifest"


def append_measured(messages: DataFrame, path: str, log: str = "log") -> None:
    """Append messages, which carry ``log``, and their sums by log and hour.

    An append has a folder of its own. It counts once its lines in the manifest are
    written, which is the last step; what an append that failed has left is never read.
    """
    name = uuid.uuid4().hex
    told = messages.withColumns(
        {
            "log": F.col(log),
            "bytes": F.coalesce(F.octet_length("message"), F.lit(0)).cast("long"),
            "hour": F.floor(F.col("timestamp") / HOUR_MS),
            "day": F.floor(F.col("timestamp") / (24 * HOUR_MS)),
        }
    )
    by = [F.col("log"), F.col("day")]
    told.hint("rebalance", *by).write.partitionBy("log", "day").parquet(f"{path}/{DATA}/append={name}")
    # Only the narrow column of sizes is read again.
    stored = _data(messages.sparkSession, path).filter(F.col("append") == name)
    sums = stored.groupBy("append", "log", "day", "hour").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("events"))
    sums.coalesce(1).write.mode("append").parquet(f"{path}/{MANIFEST}")


def _data(spark: SparkSession, path: str) -> DataFrame:
    stored = spark.read.option("basePath", f"{path}/{DATA}").parquet(f"{path}/{DATA}")
    kinds = {"append": "string", "log": "string", "day": "bigint"}
    return stored.withColumns({name: F.col(name).cast(kind) for name, kind in kinds.items()})


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """append, log, day, hour, bytes and events."""
    return spark.read.parquet(f"{path}/{MANIFEST}")


def newest_of(spark: SparkSession, path: str, max_bytes: int) -> DataFrame:
    """Per log the newest messages whose sizes add up to ``max_bytes`` at most; a limit of 0 keeps all."""
    lines = manifest(spark, path)
    data = _data(spark, path)
    hours = lines.groupBy("log", "hour").agg(F.sum("bytes").alias("_sum"))
    kept = lines.select("append", "log", "day", "hour").distinct()
    if max_bytes:
        newer = Window.partitionBy("log").orderBy(F.desc("hour")).rowsBetween(Window.unboundedPreceding, -1)
        hours = hours.withColumn("_newer", F.coalesce(F.sum("_sum").over(newer), F.lit(0)))
        hours = checkpointed(hours.filter(F.col("_newer") <= max_bytes).withColumn("_edge", F.col("_newer") + F.col("_sum") > max_bytes))
        kept = kept.join(hours, ["log", "hour"])
    kept = checkpointed(kept)
    n = kept.count()
    # The partitions of these days alone are read: the join prunes them at run time.
    rows = bounded_join(data, kept, ["append", "log", "day", "hour"], n, "inner")
    if not max_bytes:
        return rows.drop("append", "day", "hour", "bytes")
    edge = rows.filter("_edge")
    times = edge.groupBy("log", "timestamp", "_newer").agg(F.sum("bytes").alias("_sum"))
    times = edge_of(times, "log", "timestamp", max_bytes).select("log", F.col("timestamp").alias("_time"), F.col("_newer").alias("_ahead"))
    times = checkpointed(times)
    # Without such a millisecond the whole hour fits: it was no edge.
    marked = bounded_join(rows, times, ["log"], times.count())
    newest = Window.partitionBy("log").orderBy(F.desc("seq"), F.desc("stream_id"))
    last = marked.filter("timestamp = _time").withColumn("_upto", F.col("_ahead") + F.sum("bytes").over(newest))
    names = [name for name in data.columns if name not in ("append", "day", "hour", "bytes")]
    whole = marked.filter("_time is null or timestamp > _time")
    return whole.select(names).unionByName(last.filter(F.col("_upto") <= max_bytes).select(names))
