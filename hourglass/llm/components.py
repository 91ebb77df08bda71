"""Connected components of a graph in DataFrames (alternating large and small stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.common import checkpoint, shuffled, tidy


def _star(edges: DataFrame, smaller_only: bool) -> DataFrame:
    """Hang the neighbours of every node on the least node of its neighbourhood.

    Large star: the larger neighbours; small star: the smaller ones and the node itself.
    """
    if smaller_only:
        nb = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        nb = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    # checkpointed, so that the join shuffles plain rows on both sides and AQE may split a hub's partition
    least = checkpoint(nb.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")))
    hung = nb.join(shuffled(least), "u")
    if smaller_only:
        out = hung.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        out = hung.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    return out.where(F.col("a") != F.col("b")).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of the undirected ``edges (a, b)``; the component is its
    least node.  Loops, repeated edges and null ends are ignored; no edges give no rows.

    A hub's edges are aggregated before they are shuffled and joined to one row, so its partition can
    be split; every round is checkpointed.
    """
    e = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = checkpoint(e)
    mark = _mark(e)
    for _ in range(rounds):
        e = checkpoint(_star(checkpoint(_star(e, False)), True))
        now = _mark(e)
        if now == mark:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        mark = now
        tidy(edges.sparkSession)
    raise RuntimeError(f"components have not settled after {rounds} rounds")
