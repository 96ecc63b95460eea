"""A spec applied to a stream of envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.envelope import COLUMNS
from millrace.operators.stateless import filter_types
from millrace.plans.pipeline import prepared
from millrace.plans.spec import PipelineSpec
from millrace.streaming import stages


def configure_state(spark: SparkSession) -> SparkSession:
    """Keep state in RocksDB, on disk and in the checkpoint, not in executor memory."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return spark


def run_stream(df: DataFrame, spec: PipelineSpec, live: bool = False) -> DataFrame:
    """Apply ``spec`` to every stream of a streaming frame; no row is dropped for being late.

    On a ``live`` stream batches also close, and dedup forgets, by the clock; such a query does
    not end by itself, so a run with ``availableNow`` leaves ``live`` off. A changed spec takes a new
    checkpoint: state starts afresh, as it does for a changed pipeline on batch frames.
    """
    configure_state(df.sparkSession)
    rows = prepared(filter_types(df, spec.match_types), spec)
    if spec.ttl_ms is not None:
        rows = stages.dedup(rows, spec.ttl_ms, live)
    if spec.threshold:
        rows = stages.threshold(rows, spec.threshold.path, spec.threshold.delta)
    if spec.batch:
        rows = stages.batch(rows, spec.batch.max_size, spec.batch.interval_ms, live)
    return rows.select(COLUMNS)
