"""Connected components by alternating large and small stars, all rounds on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle

MOST_ROUNDS = 60


def _large_star(links: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest node around it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a != b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them. Needs a > b."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).filter("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long) but the roots; a root is the smallest node of its component.

    Rounds grow with the logarithm of the longest chain. Each is written to the
    shared folder; the driver sees a count and a checksum of it. A node with very
    many links is divided by the joins, since its minimum is one row.
    """
    links = settle(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    for _ in range(MOST_ROUNDS):
        state = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen or not state[0]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
        links = settle(_small_star(_large_star(links)), "links")
    raise RuntimeError(f"components have not settled after {MOST_ROUNDS} rounds")
