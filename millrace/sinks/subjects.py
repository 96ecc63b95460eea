"""Routing by a table of subject patterns, however many there are.

The patterns form a trie, kept as a table of edges from prefix to prefix. Each distinct topic, not each
message, walks down it token by token by equi-joins on (prefix, token), along its own token
and along ``*``; a final ``>`` takes any rest. The first pattern by rank decides, and messages
find their log by one join on the topic. Messages that no pattern captures come out with no log, in the same pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.slices import bounded_join
from millrace.session import checkpointed


def routed_by_table(messages: DataFrame, patterns: DataFrame) -> DataFrame:
    """Add ``log``, that of the least ``rank`` among the patterns ``(log, rank, pattern)`` that capture the topic; else NULL.

    Of equal ranks the log first by name counts. A NULL topic has no log.
    """
    topics = messages.select("topic").filter("topic is not null").distinct()
    found = checkpointed(captures(topics, patterns).groupBy("topic").agg(F.min(F.struct("rank", "log")).alias("first")))
    return bounded_join(messages, found.select("topic", F.col("first.log").alias("log")), ["topic"], found.count())


def captures(topics: DataFrame, patterns: DataFrame) -> DataFrame:
    """``topic`` with ``log`` and ``rank`` of every pattern that captures it."""
    tokens = F.split("pattern", r"\.")
    known = patterns.select("log", "rank", tokens.alias("tokens"))
    known = known.withColumn("rest", (F.element_at("tokens", -1) == ">"))
    known = checkpointed(known.withColumn("fixed", F.when(F.col("rest"), F.size("tokens") - 1).otherwise(F.size("tokens"))))
    size = known.agg(F.count("*").alias("n"), F.max("fixed").alias("depth")).first()
    if not size.n:
        return topics.select("topic", F.lit(None).cast("string").alias("log"), F.lit(0).alias("rank")).limit(0)
    ends = known.select("log", "rank", "rest", F.array_join(F.slice("tokens", 1, F.col("fixed")), ".").alias("prefix"), F.col("fixed").alias("depth"))
    # A prefix of n tokens has the first n of them; the root has none.
    steps = known.filter("fixed > 0").select("tokens", F.explode(F.sequence(F.lit(1), F.col("fixed"))).alias("depth"))
    edges = steps.select(
        "depth",
        F.array_join(F.slice("tokens", 1, F.col("depth") - 1), ".").alias("prefix"),
        F.element_at("tokens", F.col("depth")).alias("token"),
        F.array_join(F.slice("tokens", 1, F.col("depth")), ".").alias("next"),
    )
    edges = checkpointed(edges.distinct())
    # Near the root a few edges and ends meet all topics: what a level holds decides how it is joined.
    held = {r.depth: r.n for r in edges.groupBy("depth").agg(F.count("*").alias("n")).collect()}
    ended_at = {r.depth: r.n for r in ends.groupBy("depth").agg(F.count("*").alias("n")).collect()}
    at = topics.select("topic", F.split("topic", r"\.").alias("own"), F.lit("").alias("prefix"))
    matches = []
    for depth in range(size.depth + 1):
        left = F.slice("own", depth + 1, F.greatest(F.size("own") - depth, F.lit(0)))
        over = F.size("own") == depth
        # A rest is one token or more, none of them empty.
        going = (F.size("own") > depth) & ~F.array_contains(left, "")
        here = ends.filter(F.col("depth") == depth).drop("depth")
        ended = bounded_join(at, here, ["prefix"], ended_at.get(depth, 0), "inner")
        matches.append(ended.filter(F.when(F.col("rest"), going).otherwise(over)).select("topic", "log", "rank"))
        if depth < size.depth:
            token = F.get("own", F.lit(depth))
            tried = F.when(token == "", F.array(token)).otherwise(F.array_distinct(F.array(token, F.lit("*"))))
            walking = at.filter(F.size("own") > depth).withColumn("token", F.explode(tried))
            level = edges.filter(F.col("depth") == depth + 1).drop("depth")
            at = bounded_join(walking, level, ["prefix", "token"], held.get(depth + 1, 0), "inner").select("topic", "own", F.col("next").alias("prefix"))
    return reduce(DataFrame.unionByName, matches)
