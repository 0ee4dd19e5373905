"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plumbline.sources.staging import staged

ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to its smallest neighbour. Edges have a < b."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    tied = edges.join(least, "b").where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return tied.union(least.select(F.col("m").alias("a"), "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is the smallest node reached.

    Each round is two grouped minima and joins, never a gathered neighbourhood, and is written
    once, so a lost executor costs one round at most. Rounds go on until the edges stay the same;
    they grow with the logarithm of the longest chain.
    """
    edges = staged(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")

    def mark(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    before = mark(edges)
    for _ in range(ROUNDS):
        if not before[0]:
            break
        edges = staged(_small_star(_large_star(edges)), "edges")
        after = mark(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(edges.select("a", "a").distinct())
