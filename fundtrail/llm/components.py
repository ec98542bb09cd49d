"""Connected components of an edge list, in Spark.

Alternating rounds (every node tells its larger neighbours, then its smaller
ones, about the smallest node it knows) until the edges are stars. A round is one
aggregate with map-side combining and one join, whose hot side Spark may split;
no neighbour list is ever gathered. Every round is written to the shared
folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundtrail.session import materialize


def _settled(edges: DataFrame) -> bool:
    """Whether the edges (larger to smaller node) are stars: no centre has a smaller neighbour of its own."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    odd = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return odd.where("out > 1 OR (out > 0 AND into > 0)").isEmpty()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Self-edges and nulls are ignored; edges may repeat and may point either
    way. ``max_rounds`` only guards against a fault: the rounds needed grow
    with the logarithm of the longest chain, and running out is an error.
    """
    clean = edges.select("a", "b").where("a is not null and b is not null and a <> b")
    current = materialize(
        clean.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    for _ in range(max_rounds):
        if _settled(current):
            roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
        both = current.union(current.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # larger neighbours, and the node itself, learn the smallest node known here
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).union(least.select("a", F.col("m").alias("b")))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        # smaller neighbours learn it too
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least)
        current = materialize(small.where("a <> b").distinct(), "edges")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
