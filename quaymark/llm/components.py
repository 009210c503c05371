"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quaymark.session import materialize


def connected_components(links: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """``(node, component)`` of every node that occurs in ``links``; the component is its smallest node.

    Each round joins every node to the smallest neighbour it knows of (first of its larger
    neighbours, then of its smaller ones), which shortens paths until all components are
    stars.  A round is two aggregations and two joins on the node; minima combine before the
    shuffle and adaptive execution splits a join on a node with very many links.  Every
    round is written to the shared folder, so a lost executor costs one round at most.
    Links with a null end and links from a node to itself count for nothing.
    """
    ends = links.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a <> b")
    edges = materialize(ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            break
        before = state
        # Large star: the larger neighbours of a node move to the smallest node in its neighbourhood.
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = edges.select(F.col("v").alias("u"), F.col("u").alias("v")).join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(large.where("u <> v").distinct(), "large_star")
        # Small star: a node and its smaller neighbours move to the smallest of these.
        lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
        joined = edges.join(lowest, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(lowest.select("u", F.col("m").alias("v")))
        edges = materialize(small.where("u <> v").distinct(), "small_star")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
