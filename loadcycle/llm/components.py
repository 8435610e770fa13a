"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcycle.llm.common import cut


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Each node ties its larger neighbours to the smallest of its neighbourhood."""
    around = _both_ways(links)
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return around.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node ties its smaller neighbours and itself to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """node and root (the smallest node reachable) for each node that has a link to another one.

    ``links`` has two sortable columns a and b. Each round is written to the shared folder, so its lineage is one
    step long, and the rounds end when the links no longer change; their number grows with the logarithm of the
    longest path. Links of a node to itself count for nothing.
    """
    now = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    before = None
    for _ in range(rounds):
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        now = cut(_small_star(_large_star(now)), "links")
    raise RuntimeError("the components did not settle")
