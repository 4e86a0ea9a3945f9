"""Connected components of an edge table: distributed union-find by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxalith.llm.common import staged, unstage


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, root) for every node of edges (a long, b long); root is the component's smallest node.

    Each round hangs every node's larger neighbours, then its smaller ones, on the smallest it knows, until nothing changes:
    the number of rounds grows with the logarithm of a component's diameter. Neighbours are never gathered in one row, so a
    node with very many is no hot spot. Self-loops and repeated edges are allowed. No edges: no rows.
    """
    now = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).filter("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        after = staged(small.filter("u > v").distinct())
        open_ = after.join(after.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count()
        unstage(now)
        now = after
        if not open_:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
