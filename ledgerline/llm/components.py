"""Connected components of a large sparse graph, by alternating large and small stars.

Each round is two grouped minima and joins; rounds grow with the logarithm of the longest path.  Every round is written
to the shared folder, so that lineage stays short and lost executors cost one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (a, b) with a > b.  Large: link every larger neighbour to the least one; small: the smaller ones."""
    if large:
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
        joined = staged(near, "near").join(staged(least, "least"), "a").where("b > a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("root"))
        joined = (
            edges.join(staged(least, "least"), "a")
            .select(F.col("b").alias("a"), F.col("root").alias("b"))
            .unionByName(least.select("a", F.col("root").alias("b")))
        )
    return joined.where("a > b").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of every node with an edge; root is the component's least node.  edges: a, b, in any order."""
    current = staged(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "edges"
    )
    seen = None
    for _ in range(rounds):
        mark = current.agg(
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("a", "b")).alias("x"),
            F.sum(F.xxhash64("b", "a").cast("decimal(20,0)")).alias("s"),
        ).head()
        if mark == seen or mark["n"] == 0:
            break
        seen = mark
        current = staged(_star(staged(_star(current, True), "large"), False), "small")
    else:
        raise RuntimeError(f"no end after {rounds} rounds")
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
