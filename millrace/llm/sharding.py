"""Shards of a reproducible shuffle whose places can be computed.

Rows get global numbers 0 .. n-1 in the order of (doc_id, size, text_crc32), nulls
first. A keyed Feistel network permutes the numbers: a number below width * height
is a pair (column, row), and each round adds a keyed hash of one half to the other.
The domain is the least such rectangle around n, so that it exceeds n by less than
one side; a number that lands beyond n is permuted again until it lands below
(cycle walking). Place p is slot p div shards of shard p mod shards: counts are at
most one apart, slots have no gap, and both directions are arithmetic. Only
DataFrame functions are used.

The law is ``rows``: counts of shards are at most one apart. Equal texts are rows of
their own and may lie in different shards.

Defined results: a null text has no bytes and the checksum of the empty text; null
and repeated doc_ids are rows as others, and rows equal in doc_id, size and checksum
share out their places in any order. An empty table gives an empty result. Columns
other than doc_id and text do not matter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from millrace.llm.common import pick, saved, text_or_empty

ROUNDS = 6
SEED = 20_240_601
#: The prime 2^31 - 1; products of two numbers below it fit in a long.
PRIME = 2_147_483_647
#: Walks end well within so many steps. A walk leaves the range at most as often as numbers
#: exceed it: less than a side of the rectangle. Each step does so with chance 1 / side.
STEPS = 64
#: Rows of one partition while they are numbered; the number of partitions is what is broadcast.
ROWS_PER_PARTITION = 2_000_000


def round_keys(seed: int, rounds: int = ROUNDS) -> list[int]:
    """Keys of the rounds, drawn from the seed."""
    keys, state = [], seed % (PRIME - 1) + 1
    for _ in range(rounds):
        state = state * 48_271 % PRIME
        keys.append(state)
    return keys


def _mixed(half: Column, key: Column) -> Column:
    """A keyed hash below PRIME; also defined for halves beyond it."""
    prime = F.lit(PRIME)
    once = F.pmod(F.pmod(half, prime) + F.floor(half / prime) * 69_621 + key, prime)
    twice = F.pmod(F.pmod(once * once, prime) * F.lit(16_807) + key, prime)
    return F.pmod(twice * twice + F.floor(twice / 65_536), prime)


def _once(number: Column, width: int, height: int, keys: list[int], back: bool = False) -> Column:
    """One pass through the network, or back through it."""
    sign = -1 if back else 1
    order = list(enumerate(keys))[::sign]
    rounds = F.array(*(F.struct(F.lit(i % 2 == 0).alias("first"), F.lit(k).cast("long").alias("key")) for i, k in order))
    start = F.struct(F.floor(number / height).alias("column"), F.pmod(number, F.lit(height)).alias("row"))

    def step(state: Column, r: Column) -> Column:
        column = F.when(r["first"], F.pmod(state["column"] + sign * _mixed(state["row"], r["key"]), F.lit(width)))
        row = F.when(~r["first"], F.pmod(state["row"] + sign * _mixed(state["column"], r["key"]), F.lit(height)))
        return F.struct(
            column.otherwise(state["column"]).cast("long").alias("column"), row.otherwise(state["row"]).cast("long").alias("row")
        )

    start = start.cast("struct<column:bigint,row:bigint>")
    return F.aggregate(rounds, start, step, lambda state: state["column"] * F.lit(height) + state["row"])


def permuted(number: Column, n: int, seed: int = SEED, back: bool = False) -> Column:
    """The place of a number in a permutation of 0 .. n-1, or the number at a place."""
    width = max(1, math.isqrt(max(n - 1, 0)) + 1)
    height = max(1, -(-n // width))
    keys = round_keys(seed)
    walk = F.aggregate(
        F.sequence(F.lit(2), F.lit(STEPS)),
        _once(number.cast("long"), width, height, keys, back),
        lambda at, _: F.when(at < n, at).otherwise(_once(at, width, height, keys, back)),
    )
    return F.when(walk < n, walk).otherwise(F.raise_error(F.lit("a walk did not end")).cast("long"))


def numbered(rows: DataFrame, order: list[str], name: str = "number") -> DataFrame:
    """``rows`` with consecutive numbers from 0 in the order of the columns ``order``.

    Ranges of the order are numbered each for itself and moved by the count of what lies
    before. Rows equal in all of ``order`` are told apart by a tag, so that no range is bound
    to hold them all.
    """
    spark = rows.sparkSession
    tagged = saved(rows.withColumn("__tag", F.monotonically_increasing_id()))
    parts = max(tagged.count() // ROWS_PER_PARTITION + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranges = saved(tagged.repartitionByRange(parts, *order, "__tag").withColumn("__range", F.spark_partition_id()))
    sizes = ranges.groupBy("__range").agg(F.count("*").alias("__rows"))
    before = W.Window.orderBy("__range").rowsBetween(W.Window.unboundedPreceding, -1)
    offsets = sizes.select("__range", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    place = F.row_number().over(W.Window.partitionBy("__range").orderBy(*order, "__tag"))
    return (
        ranges.withColumn("__place", place)
        .join(F.broadcast(offsets), "__range")
        .withColumn(name, (F.col("__before") + F.col("__place") - 1).cast("long"))
        .drop("__range", "__tag", "__place", "__before")
    )


def sharded(docs: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, number, shard and slot of every row of ``docs``."""
    text = text_or_empty()
    narrow = pick(docs, "doc_id", "text").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows = numbered(narrow, ["doc_id", "size", "text_crc32"])
    place = permuted(F.col("number"), docs.count(), seed)
    return rows.withColumn("place", place).select(
        "doc_id",
        "size",
        "text_crc32",
        "number",
        F.pmod("place", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("place") / shards).cast("long").alias("slot"),
    )


def number_at(shard: Column, slot: Column, n: int, shards: int, seed: int = SEED) -> Column:
    """The number of the row in a slot: what a reader needs to fetch it."""
    return permuted(slot * shards + shard, n, seed, back=True)
