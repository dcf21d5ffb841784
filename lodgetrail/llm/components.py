"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodgetrail.llm import tables


def _least(edges: DataFrame) -> DataFrame:
    """Each left end's least neighbour, itself included. Sums up in each task first, so a hub stays small."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for the nodes of ``u``, ``v`` edges: the least node that can be reached.

    Nodes without edges have no row; loops and repeated edges do no harm. Each
    round is written to the shared folder; rounds grow with the logarithm of a
    component's size.
    """
    loops = F.col("u") != F.col("v")
    now = tables.stored(edges.where(loops).select("u", "v").distinct(), "edges")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = tables.stored(large.where(loops).distinct(), "large-star")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        joined = down.join(_least(down), "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            joined.select("u", F.col("m").alias("v"))
        )
        now = tables.stored(small.where(loops).distinct(), "small-star")
        # A star per component, unchanged by a round, is the end.
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
        seen = state
