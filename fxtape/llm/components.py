"""Connected components of an edge table by alternating star contraction, as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fxtape.shared import published


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node it reaches.

    Large star: every neighbour above u is linked to the smallest neighbour of u. Small star: the
    neighbours below u and u itself are linked to the smallest of them. Both keep components as they
    are; repeated, they end in stars around the smallest nodes after a logarithmic number of rounds.
    Each round is written to the shared folder, so the lineage stays short and lost executors cost a
    round at most. Only a count and a checksum reach the driver.

    Edges with a null end, loops and repeated edges are left out. No edges give no rows. A hub's rows
    are reduced before the shuffle in the aggregations, and the joins against one row per node are
    plain inner joins, whose large partitions adaptive execution splits.
    """
    pairs = (
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .distinct()
    )
    current, mark = published(pairs, "edges"), None
    while True:
        seen = tuple(
            current.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        )
        if seen == mark or not seen[0]:
            return current.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
                current.select("lo", F.col("lo").alias("component")).distinct()
            )
        mark, current = seen, published(contracted(current), "edges")


def contracted(pairs: DataFrame) -> DataFrame:
    """One large star and one small star over (hi, lo) pairs."""
    both = pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
        pairs.select("lo", "hi")
    )
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = (
        both.join(least, "u").where("v > u AND v != m")
        .select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        .distinct()
    )
    lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
    small = (
        large.join(lowest, "hi").where("lo != m").select(F.col("lo").alias("hi"), "m")
        .union(lowest.select("hi", "m"))
    )
    return small.select("hi", F.col("m").alias("lo")).distinct()
