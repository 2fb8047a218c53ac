"""Connected components of a graph given by its links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.sources.scratch import written


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node`` and ``root``, the smallest node that it is linked with over any number of links.

    ``links`` has two columns of one orderable type, ``a`` and ``b``; nodes without a link, and
    links of a node with itself, are left out. Each round connects every node to the least of
    its neighbours, first from above and then from below, which halves distances. Only the least
    neighbour of a node is ever gathered, so a hub costs no task more than its share.
    """
    edges = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    for step in range(most_rounds):
        # Larger neighbours go to the least of a node's neighbours and itself.
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        above = both.where(F.col("b") > F.col("a")).join(low, "a")
        large = written(
            above.select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct(), f"large-star-{step}"
        )
        # Then a node and all its smaller neighbours go to the least of these.
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        below = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = below.union(low.select("a", F.col("low").alias("b")))
        edges = written(small.where("a <> b").distinct(), f"small-star-{step}")
        if _is_settled(edges):
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
    raise RuntimeError(f"components are not settled after {most_rounds} rounds")


def _is_settled(edges: DataFrame) -> bool:
    """Whether every node has one link down at most, and none where another one ends."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    counted = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return not counted.where("down > 1 OR (down = 1 AND up = 1)").take(1)
