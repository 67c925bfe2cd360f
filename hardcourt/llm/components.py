"""Connected components of an edge table by alternating large-star and small-star steps, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from hardcourt.llm.runtime import Scratch


def _least(edges: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame, bool]:
    """Edges in both directions, every node's least neighbour (or itself), and whether the components are stars already.

    The neighbours are written before they are joined, so that the join is of plain tables and Spark may split it at a
    node with many edges. The driver sees the number of nodes that hang on two others, or hang on one and hold another.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.groupBy("a").agg(F.min("b").alias("m"), F.count_if(F.col("b") < F.col("a")).alias("down"), F.count_if(F.col("b") > F.col("a")).alias("up"))
    seen = Observation()
    odd = F.count_if((F.col("down") > 1) | ((F.col("down") > 0) & (F.col("up") > 0)))
    least = scratch.stored(near.observe(seen, F.coalesce(odd, F.lit(0)).alias("odd")).select("a", F.least("a", "m").alias("m")))
    return both, least, seen.get["odd"] == 0


def stars(edges: DataFrame) -> DataFrame:
    """(a, b): each node that is not the least of its component, with that. edges: (a, b), in any order.

    A node's neighbours are never gathered: only minima and joins, which Spark can split at a node with many edges.
    Of the tables of the steps only the last stays.
    """
    scratch = Scratch(edges.sparkSession)
    now = scratch.stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        both, least, done = _least(now, scratch)
        if done:
            scratch.drop(least)
            return now
        # large star: a node's larger neighbours hang on its least one
        large = scratch.stored(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").distinct())
        scratch.drop(now, least)
        # small star: so do its smaller ones, and itself
        least = scratch.stored(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        now = scratch.stored(small.filter("a > b").distinct())
        scratch.drop(large, least)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of the component of every node that has an edge."""
    return rooted(stars(edges))


def rooted(flat: DataFrame) -> DataFrame:
    return flat.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(flat.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
