"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _digest(edges: DataFrame) -> tuple:
    """Count and checksum of a set of edges: equal if nothing changed."""
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("s")).first()
    return row.n, row.s


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(hi, lo)``, hi > lo, that isn't its component's smallest.

    Large star: each node hands the smallest of its neighbourhood to its larger
    neighbours.  Small star: the same among its smaller neighbours.  Minima are
    partial aggregates, so a hub with very many neighbours is combined before
    the shuffle, and checkpointed, so that AQE can split the join that hands them
    out.  Every round is checkpointed.  Ends when a round changes nothing:
    then all edges are (node, root).
    """
    edges = edges.select("hi", "lo").distinct().checkpoint()
    seen = _digest(edges)
    while True:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).checkpoint()
        large = (both.filter("v > u").join(least, "u")
                 .select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        large = large.checkpoint()
        least = large.groupBy("hi").agg(F.min("lo").alias("m")).checkpoint()
        small = (large.join(least, "hi").select(
            F.explode(F.array(F.struct(F.col("hi"), F.col("m").alias("lo")),
                              F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
            .select("e.hi", "e.lo").filter("hi > lo").distinct())
        edges = small.checkpoint()
        now = _digest(edges)
        if now == seen:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        seen = now
