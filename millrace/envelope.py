"""The event envelope, the only table the library works on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ``timestamp`` is the receive time in Unix milliseconds. ``seq`` is the arrival
# order within a stream: ordered operators go by ``(timestamp, seq)``.
ENVELOPE = T.StructType(
    [
        T.StructField("stream_id", T.StringType(), False),
        T.StructField("topic", T.StringType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("type", T.StringType(), False),
        T.StructField("timestamp", T.LongType(), False),
        T.StructField("payload", T.StringType(), True),
        T.StructField("seq", T.LongType(), False),
    ]
)

COLUMNS = ENVELOPE.fieldNames()
ORDER = ["timestamp", "seq"]


def envelopes(df: DataFrame, type, payload, stream_id="stream_id", timestamp="recv_ms") -> DataFrame:
    """Build envelopes from a capture with ``topic`` and ``seq`` columns."""
    stream = F.col(stream_id) if isinstance(stream_id, str) else stream_id
    time = F.col(timestamp) if isinstance(timestamp, str) else timestamp
    return df.select(
        stream.alias("stream_id"),
        F.col("topic"),
        stream.alias("source"),
        type.alias("type"),
        time.cast("long").alias("timestamp"),
        payload.alias("payload"),
        F.col("seq").cast("long").alias("seq"),
    )


def with_event_time(df: DataFrame) -> DataFrame:
    """Add ``event_time``, the timestamp type that watermarks need."""
    return df.withColumn("event_time", F.timestamp_millis("timestamp"))
