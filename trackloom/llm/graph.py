"""Connected components of a link table, by alternating large and small stars.

Both steps are a minimum per node (combined before the shuffle) and an equi-join, so a node with many links costs one
row a task in the aggregate and may be split in the join. Nothing is collected but a count per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop


def components(links: DataFrame) -> DataFrame:
    """links (a, b), any direction, without nulls -> (node, component): the smallest node reachable, for every linked node but that smallest one."""
    up = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    cur = cut(up, "links")
    mark = _mark(cur)
    while True:
        # Large star: each node's larger neighbours move to the smallest of its neighbours and itself.
        low = cur.groupBy("u").agg(F.min("v").alias("m"))
        by_v = cur.select(F.col("v").alias("n"), F.col("u").alias("w"))
        large = by_v.join(low.select(F.col("u").alias("n"), "m"), "n", "left").select(F.col("w").alias("u"), F.coalesce("m", "n").alias("v")).distinct()
        large = cut(large, "large")
        # Small star: each node's smaller neighbours and itself move to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = cut(moved.union(low.select("u", F.col("m").alias("v"))).distinct(), "small")
        drop(cur, large)
        cur = small
        now = _mark(cur)
        if now == mark:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = now


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.col("v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("u", "v"))).first())
