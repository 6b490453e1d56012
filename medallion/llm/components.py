"""Connected components of links by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of the links (a, b); the component is its least node.

    Each round points the larger neighbours of a node, then the smaller ones, to the
    least neighbour, until every node points to the least of its component. No node's
    neighbours are gathered: both steps are a least value per node and a join.
    """
    edges = written(links.select("a", "b").filter("a <> b").distinct(), "links", release=True)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: larger neighbours of a go to the least node around a
        large = (
            both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a <> b").distinct()
        )
        # small star: a and its smaller neighbours go to the least of those
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            down.join(low, "a")
            .select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
            .select("e.a", F.col("e.m").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        following = written(small, "links")
        # settled once no node has two targets and no target has one of its own
        ends = following.select("a", F.lit(1).alias("n")).union(
            following.select("b", F.lit(0)).distinct()
        ).groupBy("a").agg(F.sum("n").alias("n"), F.min("n").alias("target"))
        edges = following
        if ends.filter("n > 1 OR (n = 1 AND target = 0)").isEmpty():
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
