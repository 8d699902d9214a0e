"""Connected components by alternating large-star and small-star rounds.

Minima are combined before the shuffle, so the centre of a star of any size is no hot group. Where edges meet their
centre's minimum, centres of over HOT edges are joined by broadcast (there is at most one of them for each HOT edges;
beyond BROADCAST_IDS of them it is a shuffle that adaptive execution may split), all others by a shuffle. Every round
is checkpointed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._io import BROADCAST_IDS, checkpoint, tidy

HOT = 1_000


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def with_least(edges: DataFrame, least: DataFrame, n: int) -> DataFrame:
    """n edges (u, v) with m of least (u, m, k: number of edges)."""
    if n <= HOT:
        return edges.join(least.drop("k"), "u")
    least = checkpoint(least)
    hot = least.where(F.col("k") > HOT)
    n = hot.limit(BROADCAST_IDS + 1).count()
    if not 0 < n <= BROADCAST_IDS:
        return edges.join(least.drop("k"), "u")
    cold = edges.join(F.broadcast(hot.select("u")), "u", "left_anti").join(least.where(F.col("k") <= HOT).drop("k"), "u")
    return edges.join(F.broadcast(hot.drop("k")), "u").unionByName(cold)


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) of every node in edges (u, v: long)."""
    now = checkpoint(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"), F.count("*").alias("k"))
        large = with_least(both, least, 2 * mark[0]).where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = checkpoint(large) if 2 * mark[0] > HOT else large
        small = with_least(large, large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("k")), 2 * mark[0])
        small = small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        now, was = checkpoint(small.distinct()), mark
        mark = _mark(now)
        del both, least, large, small
        tidy(edges.sparkSession)
        if mark == was:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
