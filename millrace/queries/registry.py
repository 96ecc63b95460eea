"""The queries on the given tables, each with the SQL that tells its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of ``(spark, sf_dir)`` under its own name."""

    def register(function: Query) -> Query:
        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(configure(spark), sf_dir)

        QUERIES[function.__name__] = configured
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register
