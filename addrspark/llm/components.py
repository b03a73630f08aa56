"""Connected components of an edge list that no single machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrspark.llm.shared import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns u, v): root is the smallest node it reaches.

    Alternates large-star and small-star steps, which need about log(n) rounds. Each step is a minimum per
    node, combined before the shuffle, and a join that adaptive execution splits where a node is hot. Every
    round is written, so a lost executor costs a round at most.
    """
    edges = edges.filter(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).distinct()
    edges = written(edges, "edges")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before or state["n"] == 0:
            break
        before = state
        edges = written(_small_star(_large_star(edges)), "edges")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node point to the least of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # In an edge (u, v) with u > v, u is the larger neighbour of v.
    return edges.join(least.withColumnRenamed("u", "v"), "v").select("u", F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of every node, and the node itself, point to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    near = edges.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
