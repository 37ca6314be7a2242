"""Connected components by alternating star contraction, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import written


def state_of(edges: DataFrame) -> tuple:
    """Count and order-free digest, to see whether a round changed anything."""
    return tuple(
        edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("long"))).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of longs to (node, root): the smallest node each linked node can reach.

    Each round points the neighbours of a node to the least among them, first the larger ones,
    then the smaller ones, until only stars are left.  A hub is never gathered in one group:
    the least neighbour is an aggregate, and it goes back to the edges by a join.
    """
    now = written(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    before = state_of(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        now = written(
            small.select("a", F.col("m").alias("b"))
            .unionByName(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
            .distinct()
        )
        after = state_of(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
