"""Connected components of a link table by alternating large and small stars.

Every half step is one aggregate and one join; both sides of the join are
checkpointed tables, so AQE can split the rows of a hub.  Edges and labels
stay distributed: only a count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.llm.common import saved


def _checksum(e: DataFrame):
    return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of an edge; ``root`` is the smallest node reachable.

    Null ends, loops and repeated edges are ignored.
    """
    e = saved(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                   .where("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct())
    seen = _checksum(e)
    while seen[0]:
        # large star: every larger neighbour of u is tied to the smallest of u's closed neighbourhood
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = saved(both.groupBy("u").agg(F.min("v").alias("m")))
        e = saved(both.where("v > u").join(low, "u")
                      .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        # small star: u and its smaller neighbours are tied to the smallest of them
        low = saved(e.groupBy("u").agg(F.min("v").alias("m")))
        e = saved(e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                   .union(low.select("u", F.col("m").alias("v"))).distinct())
        now = _checksum(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")) \
            .union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
