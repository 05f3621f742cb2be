"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.session import ensure_checkpoint_dir


def _down(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger node to the smaller."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component``: the least node that each node reaches.  Nodes without an edge to another are left out.

    Rounds of two steps hang every node's neighbours on the least of them until all that is left are stars.
    A node with very many edges is only ever aggregated, or split in a join, never gathered.  Rounds grow with the
    logarithm of the longest path; each is checkpointed.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    now = _down(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))).checkpoint()
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")).checkpoint()
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = _down(large.unionByName(least.select("a", F.col("m").alias("b"))))
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(small, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = _down(moved.unionByName(small.select("a", F.col("m").alias("b")))).checkpoint()
        ends = now.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("top")).unionByName(
            now.select(F.col("b").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("top")))
        unsettled = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("top").alias("top")).where("up + top > 1")
        if unsettled.isEmpty():
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
