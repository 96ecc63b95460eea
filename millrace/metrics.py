"""Counters per stream, and the report built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from millrace.plans.pipeline import payload_bytes


def ingested(events: DataFrame) -> DataFrame:
    """Events and payload bytes per stream, before any stage."""
    return events.groupBy("stream_id").agg(
        F.count("*").alias("events_ingested"), F.sum(payload_bytes()).alias("bytes_ingested")
    )


def dropped(fate: DataFrame) -> DataFrame:
    """Events dropped per stream and stage, from a run that kept dropped events."""
    return (
        fate.filter("dropped_by is not null")
        .groupBy("stream_id", F.col("dropped_by").alias("stage"))
        .agg(F.count("*").alias("events_dropped"))
    )


def published(results: DataFrame) -> DataFrame:
    """Events and payload bytes per stream after all stages; a batch is one event.

    They count when handed to the sink, so those it then rejects count too.
    """
    return results.groupBy("stream_id").agg(
        F.count("*").alias("events_published"), F.sum(payload_bytes()).alias("bytes_published")
    )


def reduction(fate: DataFrame) -> DataFrame:
    """One row per stream: what came in, what each stage dropped, what went out."""
    alive = F.col("dropped_by").isNull()
    return fate.groupBy("stream_id").agg(
        F.count("*").alias("events_ingested"),
        F.sum("ingested_bytes").alias("bytes_ingested"),
        *(
            F.count_if(F.col("dropped_by").eqNullSafe(stage)).alias(f"dropped_{stage}")
            for stage in ("filter", "dedup", "threshold")
        ),
        F.count_if(alive).alias("events_published"),
        F.sum(F.when(alive, payload_bytes()).otherwise(0)).alias("bytes_published"),
    )


def observed(events: DataFrame, name: str | Observation) -> DataFrame:
    """Count events and payload bytes as they pass, without a job of its own.

    Give an ``Observation`` on batch frames; on streams a name, under which each
    micro-batch's progress reports the counts.
    """
    return events.observe(
        name, F.count(F.lit(1)).alias("events"), F.sum(payload_bytes()).alias("bytes")
    )
