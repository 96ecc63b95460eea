"""Stages that look at one event at a time: filter, transform, enrich."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import json_text as J


def filter_types(df: DataFrame, match_types) -> DataFrame:
    """Keep events of the given types; no types means all."""
    return df.filter(F.col("type").isin(list(match_types))) if match_types else df


def shaped(document: Column) -> Column:
    """Whether a mapping applies: to objects, and to JSON ``null``, which has no members."""
    return J.is_object(document) | F.is_variant_null(document)


def transform(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Replace object payloads by ``{new key: value at path}``; other payloads stay."""
    if not mapping:
        return df
    document = F.col("_doc")
    flat = F.when(shaped(document), J.flat_object(document, mapping, {}))
    rewritten = F.coalesce(flat, F.col("payload"))
    return J.with_document(df).withColumn("payload", rewritten).drop("_doc")


def enrich(df: DataFrame, tags: dict[str, str]) -> DataFrame:
    """Set string tags at the root of object payloads; other payloads stay."""
    if not tags:
        return df
    tagged = J.render(J.tag(J.fields(F.col("_doc")), tags))
    return J.with_document(df).withColumn("payload", F.coalesce(tagged, F.col("payload"))).drop("_doc")
