"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portacube.llm.scratch import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u, v).

    Large star: every neighbour above u is tied to the least of u and its
    neighbours.  Small star: u and its neighbours below are tied to the least
    of them.  The minimum is a pre-aggregated group, joined back on u; a hot
    node is an ordinary skewed join, no neighbour list is ever built.
    """
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        out = (down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .union(least.select("u", F.col("m").alias("v"))))
    return out.where("u <> v").distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a lesser node, or edges from greater ones only."""
    ends = (edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up"))
            .union(edges.select("v", F.lit(0), F.lit(1))))
    node = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return node.where("down > 1 or (down > 0 and up > 0)").isEmpty()


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v: long); the component is its least node.

    Edges are staged after every pair of steps; the loop ends when they are
    stars: every node is tied to one lesser node at most, and what is tied to
    a node is tied to no other.  Self-loops and repeated edges are ignored; no
    edges give an empty result.
    """
    state = scratch.stage(edges.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u <> v").distinct(),
                          f"{name}-0")
    step = 0
    while step == 0 or not _stars(state):
        step += 1
        state = scratch.stage(_star(_star(state, True), False), f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}")
    return (state.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(state.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
