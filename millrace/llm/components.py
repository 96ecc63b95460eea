"""Connected components of links between numbers, by large and small stars.

Every round replaces the links of a number by links to the smallest number it can see,
first among larger neighbours and then among smaller ones, until nothing changes. What is
left are stars around the smallest number of each component. Rounds grow with the
logarithm of the size of a component, and no task needs all links of a number. Up to FEW links,
counted, are kept together: dealing them out anew in each step costs more than the steps do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import saved


#: Links that one task works on, 16 bytes each.
FEW = 100_000


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40))).alias("h")).first()
    return row.n, row.h or 0


def components(links: DataFrame) -> DataFrame:
    """``member`` and ``root``, the smallest number of its component, for all numbers that links (a, b) join."""
    links = saved(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    )
    state = _state(links)
    # Rounds make no more links than there are, and one partition needs no exchange.
    together = (lambda rows: rows.coalesce(1)) if state[0] <= FEW else (lambda rows: rows)
    while True:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = together(both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = together(saved(large.filter("a <> b").distinct()))
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = saved(together(small.union(lower.select("a", F.col("m").alias("b")))).distinct())
        before, state = state, _state(links)
        if state == before:
            break
    links = together(links)
    roots = links.select(F.col("b").alias("member")).distinct()
    return saved(
        links.select(F.col("a").alias("member"), F.col("b").alias("root")).union(roots.select("member", F.col("member").alias("root")))
    )
