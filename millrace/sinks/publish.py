"""Serialise envelopes, set bad ones aside and append to a durable log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions import json_text as J

# The characters a topic may have.
TOPIC_TEXT = r"\A[a-zA-Z0-9._-]+\z"

# Why an event is set aside.
NO_JSON, BEYOND_LIMITS = "no JSON", "beyond the parser's limits"


def valid_topic(topic="topic"):
    """Whether a topic is a plain name, free of wildcards and blanks."""
    return F.col(topic).rlike(TOPIC_TEXT)


def serialised(events: DataFrame) -> DataFrame:
    """Add ``message``, the JSON text of the four envelope fields, and ``refused``.

    The payload goes in as the JSON it is; a NULL payload becomes ``null``. For a
    payload that is not JSON ``message`` is NULL, and ``refused`` says why: it is no JSON, or
    it is beyond the parser's limits, so that it could not be judged.
    """
    head = F.to_json(F.struct("source", "type", "timestamp"))
    text = F.concat(
        F.substr(head, F.lit(1), F.length(head) - 1),
        F.lit(',"payload":'),
        F.coalesce("payload", F.lit("null")),
        F.lit("}"),
    )
    whole = F.col("payload").isNull() | J.is_json(F.col("_doc"))
    why = F.when(J.unjudged(F.col("_doc")), BEYOND_LIMITS).when(~whole, NO_JSON)
    return J.with_document(events).withColumns({"message": F.when(whole, text), "refused": why}).drop("_doc")


def publishable(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into events with their ``message`` and events whose payload is not JSON.

    Writing both runs ``events`` twice; ``append_all`` and ``start_append_all`` write them in one pass.
    """
    checked = serialised(events)
    good = checked.filter("message is not null").drop("refused")
    return good, checked.filter("message is null").drop("message")


def with_partitions(messages: DataFrame) -> DataFrame:
    """Add the columns the log is partitioned by: the day and the topic's first token."""
    return messages.withColumns(
        {
            "day": F.to_date(F.timestamp_millis("timestamp")),
            "topic_root": F.substring_index("topic", ".", 1),
        }
    )


LOG_PARTITIONS = ["day", "topic_root"]

#: Files that a micro-batch of a stream writes for each partition, at most.
WRITERS = 4


def append(messages: DataFrame, path: str) -> None:
    """Append to the log. Rows of a partition come together, so files stay few and large."""
    _append(with_partitions(messages), path, LOG_PARTITIONS)


def append_all(events: DataFrame, path: str) -> None:
    """Append events to the log and bad ones to the quarantine under ``path``, in one pass."""
    _append(with_partitions(_marked(events)), path, ["published", *LOG_PARTITIONS])


def published(spark: SparkSession, path: str) -> DataFrame:
    """The log that ``append_all`` or ``start_append_all`` wrote; nothing of the quarantine is read."""
    return spark.read.parquet(path).filter("published = 'true'").drop("published", "refused")


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    """The events that were set aside next to that log; their ``message`` is NULL, ``refused`` says why."""
    return spark.read.parquet(path).filter("published = 'false'").drop("published")


def refusals(quarantine: DataFrame) -> DataFrame:
    """How many events of each stream were set aside, by reason."""
    return quarantine.groupBy("stream_id", "refused").agg(F.count("*").alias("events"))


def _marked(events: DataFrame) -> DataFrame:
    return serialised(events).withColumn("published", F.col("message").isNotNull())


def _append(rows: DataFrame, path: str, by: list[str]) -> None:
    together = rows.hint("rebalance", *(F.col(name) for name in by))
    together.write.mode("append").partitionBy(*by).parquet(path)


def start_append(messages: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append a stream to the log; a restart with the same checkpoint goes on where it stopped."""
    return _start(with_partitions(messages), path, LOG_PARTITIONS, checkpoint, trigger)


def start_append_all(events: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Like ``append_all`` on a stream: one query, one state, for the log and the quarantine."""
    return _start(with_partitions(_marked(events)), path, ["published", *LOG_PARTITIONS], checkpoint, trigger)


def start_fates(fates: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append the fates of a stream's events, those that went on apart from those each stage dropped."""
    told = fates.withColumn("fate", F.coalesce("dropped_by", F.lit("published")))
    return _start(told, path, ["fate"], checkpoint, trigger)


def _start(rows: DataFrame, path: str, by: list[str], checkpoint: str, trigger: dict) -> StreamingQuery:
    # A micro-batch writes a few files for each partition, not one from every task.
    together = rows.repartition(*by, F.pmod(F.xxhash64("stream_id"), F.lit(WRITERS)))
    writer = together.writeStream.format("parquet").outputMode("append")
    writer = writer.partitionBy(*by).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start(path)
