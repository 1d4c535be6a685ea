"""Connected components by alternating stars."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node reachable.

    In turns, every node links its larger neighbours, then itself and its smaller neighbours, to the
    smallest of them all, until nothing changes; the number of rounds grows with the logarithm of the
    longest path. A round is two aggregations and joins on the node, whose large keys Spark splits.
    Each round is checkpointed, so the plan stays short and lost executors cost one round at most.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges, before = edges.distinct().checkpoint(), None
    for _ in range(most_rounds):
        edges = star(star(edges, larger=True), larger=False).checkpoint()
        now = edges.agg(
            F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % 65_536)
        ).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
                edges.select("b", "b").distinct()
            )
        before = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def star(edges: DataFrame, larger: bool) -> DataFrame:
    """edges (a, b) with a > b; links of each node moved to the smallest node around it."""
    if larger:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    lowest = both.groupBy("a").agg(F.min("b").alias("low"))
    lowest = lowest.select(F.col("a").alias("at"), F.least("a", "low").alias("low"))
    moved = both.join(lowest, F.col("a") == F.col("at"))
    if larger:
        out = [moved.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))]
    else:
        out = [
            moved.select(F.col("b").alias("a"), F.col("low").alias("b")),
            moved.select("a", F.col("low").alias("b")),
        ]
    return reduce(DataFrame.unionAll, out).where("a <> b").distinct()
