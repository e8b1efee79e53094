"""Connected components of a graph given as links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour (itself included)."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node's smaller neighbours, and the node, are tied to the smallest of them. Links come with a > b."""
    low = links.groupBy("a").agg(F.min("b").alias("low"))
    moved = links.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(low.select("a", F.col("low").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of the links (a, b) that is not its own root.

    Large and small star alternate until nothing changes: links never grow in number, every round roughly squares the
    reach of a root, and each round is cut off by a reliable checkpoint. Hot nodes meet only their own minimum.
    """
    now = checkpointed(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == before or seen[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = seen
        now = checkpointed(_small_star(_large_star(now)))
