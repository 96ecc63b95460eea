"""Envelopes that were stored before, as JSON lines or Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.envelope import ENVELOPE
from millrace.functions import json_text as J


# A member that holds a plain text, a number or a word, and what stands around a payload.
_MEMBER = r'\s*+"[^"\\]*+"\s*+:\s*+(?:"[^"\\]*+"|[-+.0-9eE]++|true|false|null)\s*+'
AROUND_PAYLOAD = rf'(?s)\A\s*+\{{(?:{_MEMBER},)*\s*+"payload"\s*+:\s*+(.*?)\s*(?:,{_MEMBER})*+\}}\s*+\z'


def from_json_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    """Envelope fields of JSON lines, next to the other columns of ``lines``.

    The payload stays text: it is the JSON under ``payload``, spelt as it is in the line. Only where a
    line has other objects or arrays beside it, or escapes in their texts, is it written anew, with
    its keys sorted.
    """
    parsed = J.with_document(lines, text, "_line")
    line = F.col("_line")
    told = parsed.withColumn("_own", F.to_json(F.try_variant_get(line, "$.payload", "variant")))
    told = told.withColumn("_spelt", F.when(F.col("_own").isNotNull(), F.regexp_extract(text, AROUND_PAYLOAD, 1)))
    # What the pattern cut out counts if it is the same JSON.
    same = F.to_json(F.col("_again")).eqNullSafe(F.col("_own"))
    return J.with_document(told, "_spelt", "_again").select(
        *(name for name in lines.columns if name != text),
        F.try_variant_get(line, "$.source", "string").alias("source"),
        F.try_variant_get(line, "$.type", "string").alias("type"),
        F.try_variant_get(line, "$.timestamp", "bigint").alias("timestamp"),
        F.when(same, F.col("_spelt")).otherwise(F.col("_own")).alias("payload"),
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Stored envelopes; partition columns of the log come along."""
    return spark.read.parquet(path)


# Input of one micro-batch unless told otherwise. Rows of one key that arrive in
# the same micro-batch meet in one task, so a stream needs such a bound.
MICRO_BATCH_BYTES = "1g"


def stream_parquet(spark: SparkSession, path: str, **options) -> DataFrame:
    """New files of stored envelopes as a stream; options go to the reader."""
    bounded = {"maxBytesPerTrigger": MICRO_BATCH_BYTES} if "maxFilesPerTrigger" not in options else {}
    return spark.readStream.schema(ENVELOPE).options(**(bounded | options)).parquet(path)
