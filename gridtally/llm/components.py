"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.common import cut


def join_own(left: DataFrame, right: DataFrame, key: str | list[str],
             how: str = "inner") -> DataFrame:
    """Join on ``key``, a column or several, with an exchange for each side.

    ``right`` has one row per key and often comes from a ``groupBy`` on it, so
    Spark would reuse that partitioning and could not split a hot key of
    ``left``. A second join column, a function of the key, makes both sides
    exchange for the join alone, and AQE may then split the hot partition.
    """
    keys = [key] if isinstance(key, str) else key
    again = F.xxhash64(*keys)
    joined = left.withColumn("_gt_again", again).join(
        right.withColumn("_gt_again", again), [*keys, "_gt_again"], how)
    return joined.drop("_gt_again")


def _starred(edges: DataFrame, including_self: bool) -> DataFrame:
    """edges (u, v) with the smallest neighbour of u (or u itself) as ``m``."""
    low = F.min("v")
    lows = edges.groupBy("u").agg((F.least(low, F.col("u")) if including_self else low).alias("m"))
    return join_own(edges, lows, "u")


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) that is not itself a root.

    A root is the smallest node of its component.

    Each round hangs every node's larger neighbours on the smallest (large
    star), then a node's smaller neighbours and itself (small star); both keep
    the components. The number of rounds grows with the logarithm of the
    longest chain. Every round's edges are checkpointed; only their count and
    one checksum reach the driver.
    """
    edges = cut(links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)).alias("n"),
                          F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if state.n == 0 or state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _starred(both, True).where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _starred(large, False).select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = cut(small.where("u <> v").distinct())
