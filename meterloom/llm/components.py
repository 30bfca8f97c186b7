"""Connected components of a link table, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of ``links(a, b)``: the smallest node reachable.

    Large-star and small-star steps take turns: every node hands its larger, then its
    smaller neighbours to the smallest one it sees, until each node hangs on its root.
    Rounds grow with the logarithm of the longest chain. Links are written to the shared
    folder after each round; nothing but two totals of a round reaches the driver.
    Null ends and self links are ignored.
    """
    links = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links, before = stage(links.distinct(), "links"), None
    while True:
        total = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(total) == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                links.select("b", "b").distinct()
            )
        before = tuple(total)
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("low"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        links = stage(small.union(low.select("a", "low")).distinct(), "links")
