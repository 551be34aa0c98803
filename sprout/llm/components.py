"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _stamp(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): every linked node and the smallest node it is linked to.

    Each round joins all larger neighbours of a node to its smallest
    neighbour, then all smaller ones; rounds grow with the logarithm of the
    component size. Every round is a written table, so a lost executor costs
    no more than that round.
    """
    edges = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                   .where("u != v").distinct(), "links")
    stamp = _stamp(edges)
    while stamp[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        large = stored(large, "large_star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(least.select("u", F.col("m").alias("v")).unionByName(moved).distinct(), "small_star")
        now = _stamp(edges)
        if now == stamp:
            break
        stamp = now
    return edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root").unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
