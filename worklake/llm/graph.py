"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worklake.llm.common import release, stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: connect neighbours of every node u to the smallest of them and u."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:  # edges run from the larger to the smaller node
        out = (joined.select(F.col("v").alias("a"), F.col("m").alias("b"))
               .unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, max_steps: int = 60) -> DataFrame:
    """(id, component) of every node with an edge; ``edges`` has long columns a and b.

    Every step groups with partial aggregation and joins, so that a node with
    very many neighbours is no single task's work. Done when each node hangs
    on the smallest of its component.
    """
    edges = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .where("a <> b").distinct(), "edges")
    spark = edges.sparkSession
    for _ in range(max_steps):
        edges = stage(_star(_star(edges, large=True), large=False), "edges")
        release(spark)
        # Stars: no node has two parents, and no parent has one itself.
        nodes = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        parents = edges.select(F.col("b").alias("a")).distinct()
        if nodes.where("n > 1").isEmpty() and nodes.join(parents, "a", "left_semi").isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {max_steps} steps")
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
