"""Connected components of a graph given as edges, by alternating star contractions.

Each step links the larger neighbours of a node (large star) or its smaller ones (small star) to the least of them, as
one grouping with a partial aggregate and one join; no neighbourhood is ever gathered. Edges shrink to stars around the
least node of each component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recall_lens.llm.staging import Staging


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """`edges` has u > v. Large: each node's larger neighbours go to its least neighbour or itself. Small: each node
    and its smaller neighbours go to the least of these."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame, staging: Staging, name: str) -> DataFrame:
    """node and root, the least node of its component, of every node of `edges` (u, v) that is not a root itself.

    Loops, repeated edges and either direction are fine; nodes of any type with an order. No edges give no rows.
    """
    current = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    current = staging.table(current, f"{name}-0")
    step = 0
    while True:
        step += 1
        current = staging.table(_star(_star(current, True), False), f"{name}-{step}")
        # stars only when no node has two parents and no parent has one
        state = current.agg(F.count("*").alias("n"), F.count_distinct("u").alias("nodes")).first()
        chained = current.join(current.select(F.col("u").alias("v")).distinct(), "v", "left_semi")
        if state.n == state.nodes and chained.isEmpty():
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
