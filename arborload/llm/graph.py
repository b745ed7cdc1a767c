"""Connected components by alternating stars.

The smallest neighbours are settled before they are joined: a join whose sides both come
straight from a shuffle lets Spark split the edges of a large star's centre.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborload.llm.shared import settle


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = settle(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = settle(edges.groupBy("u").agg(F.min("v").alias("m")))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from every node that has an edge.

    ``edges`` has long columns ``u`` and ``v``; directions, repeats and loops don't
    matter.  Returns ``node`` and ``root``, without the roots themselves.  Each round
    halves the depth of the trees or better; its edges are checkpointed, and only a
    count and a checksum of them reach the driver.
    """
    ordered = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    current = settle(ordered)
    before, after = None, _state(current)
    while after[0] and before != after:
        current = settle(_small_star(_large_star(current)))
        before, after = after, _state(current)
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
