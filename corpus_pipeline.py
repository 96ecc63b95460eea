"""A corpus made ready for training, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a table that the next one is given as
docs, written as Parquet and read again in between.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, decontamination, exact_dedup, near_dedup, toxicity
from millrace.llm.common import few_at_once
from millrace.session import shared_folder


#: Near copies share this percentage of their five-word shingles or more; op10 alone is bound to 85.
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model fitted on the labelled ones of ``docs`` rejects go."""
    few_at_once(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("grade"))
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    few_at_once(spark)
    return exact_dedup.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies, the row with the smallest doc_id stays."""
    few_at_once(spark)
    return near_dedup.dedup(docs, percent=NEAR_PERCENT)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids of the text, their number, and the text they decode to."""
    few_at_once(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe.decode(bpe.encode(docs, path), path)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("minhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("bpe", encoded),
]

#: No SQL: the model, the sketches and the vocabulary's merges are beyond it. Tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, over the whole table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
