"""Connected components of a table of links by alternating star steps, one written table per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of its neighbourhood."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select("m", F.col("b").alias("x")).unionByName(least.select("m", F.col("a").alias("x")))
    return moved.where("m <> x").select(F.col("m").alias("a"), F.col("x").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the smallest node reachable. Links are longs, a <> b.

    Ends when a round changes no link; the number of rounds grows with the logarithm of a component's diameter. Each
    round is written to the shared folder; the driver sees one number per round. No links give no rows.
    """
    sign = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    now = staged(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "stars")
    before = sign(now)
    while before[0]:
        now = staged(_small_star(_large_star(now)), "stars")
        after = sign(now)
        if after == before:
            break
        before = after
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
