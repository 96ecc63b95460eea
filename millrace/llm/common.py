"""What the operators of this package share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import shared_folder


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the columns ``names``, in that order.

    Further columns are left out before anything is computed, so they cannot
    clash with those an operator adds. Where several columns differ only in
    case, the one spelt exactly as asked for counts.
    """
    if len({c.lower() for c in df.columns}) < len(df.columns):
        places = [df.columns.index(name) for name in names]
        numbered = df.toDF(*(f"_{i}" for i in range(len(df.columns))))
        return numbered.select(*(F.col(f"_{i}").alias(n) for i, n in zip(places, names)))
    return df.select(*names)


def apart(docs: DataFrame, *names: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with its columns numbered, the columns ``names`` once more under their names, and the way back.

    What an operator adds then clashes with no column of ``docs``. The way back leaves
    the columns of ``docs`` alone, as they were.
    """
    columns, numbered = docs.columns, [f"_{i}" for i in range(len(docs.columns))]
    places = {name: f"_{columns.index(name)}" for name in names}
    told = docs.toDF(*numbered).withColumns({name: F.col(place) for name, place in places.items()})
    return told, lambda rows: rows.select(*numbered).toDF(*columns)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def saved(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and continue from the copy.

    The files have several replicas or none to lose, as the folder has it; a
    lost executor costs no more than the tasks that it was running.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few_at_once(spark: SparkSession) -> None:
    """Texts may be long: hand few of them at once to a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
