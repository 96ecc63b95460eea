"""Session settings the library relies on, and the one way it cuts lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Set the SQL options whose values change results; cluster sizing is left alone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # A JSON object that repeats a key is valid and its last value wins.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpointed(df: DataFrame, drop_shuffles: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the copy.

    With ``drop_shuffles`` the shuffle files that led to it go once it is written, not when the driver collects garbage.
    """
    spark = df.sparkSession
    shared_folder(spark)
    if not drop_shuffles:
        return df.checkpoint(eager=True)
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        # The option is read when a frame is made.
        return df.select("*").checkpoint(eager=True)
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)
