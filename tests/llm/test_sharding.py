import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import sharding


def mixed(half, key):
    p = sharding.PRIME
    once = (half % p + half // p * 69_621 + key) % p
    twice = (once * once % p * 16_807 + key) % p
    return (twice * twice + twice // 65_536) % p


def place(number, n, seed):
    """The permutation in plain Python."""
    width = math.isqrt(n - 1) + 1
    height = -(-n // width)
    while True:
        column, row = divmod(number, height)
        for i, key in enumerate(sharding.round_keys(seed)):
            if i % 2:
                row = (row + mixed(column, key)) % height
            else:
                column = (column + mixed(row, key)) % width
        number = column * height + row
        if number < n:
            return number


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 1000, 4097])
def test_permutation_and_its_inverse(spark, n):
    rows = spark.range(n).select("id", sharding.permuted(F.col("id"), n, 9).alias("place"))
    rows = rows.withColumn("back", sharding.permuted(F.col("place"), n, 9, back=True)).collect()
    assert sorted(r.place for r in rows) == list(range(n))
    assert all(r.back == r.id and r.place == place(r.id, n, 9) for r in rows)


def test_far_numbers_stay_in_range_and_come_back(spark):
    n = 30_000_000_000_001
    rows = spark.range(n - 500, n).select("id", sharding.permuted(F.col("id"), n).alias("place"))
    rows = rows.withColumn("back", sharding.permuted(F.col("place"), n, back=True)).collect()
    assert all(0 <= r.place < n and r.back == r.id for r in rows)
    assert len({r.place * 10 // n for r in rows}) == 10


SCHEMA = "doc_id long, text string, shard int, __tag string, number string"


def test_shards_against_brute_force(spark):
    given = [(i * 37 % 900, f"t{i}é", 1, "", "") for i in range(900)] + [(5, "same", 1, "", "")] * 300
    given += [(None, None, 1, "", ""), (None, "", 1, "", ""), (900, "x" * 100_000, 1, "", "")]
    docs = spark.createDataFrame(given, SCHEMA).repartition(4)
    rows = sharding.sharded(docs, 8).collect()
    n = len(given)
    key = lambda r: (r[0] is not None, r[0] or 0, len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode()))
    want = Counter()
    for number, r in enumerate(sorted(given, key=key)):
        at = place(number, n, sharding.SEED)
        want[(r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode()), at % 8, at // 8)] += 1
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in rows) == want
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1
    again = {(r.shard, r.slot): r.number for r in rows}
    found = spark.createDataFrame([(*k, v) for k, v in again.items()], "shard int, slot long, number long")
    wrong = found.filter(sharding.number_at(F.col("shard"), F.col("slot"), n, 8) != F.col("number"))
    assert wrong.count() == 0


def test_empty_table(spark):
    assert sharding.sharded(spark.createDataFrame([], SCHEMA), 8).collect() == []
