"""Connected components by alternating large-star and small-star rounds
(Kiveris et al., "Connected Components in MapReduce and Beyond")."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlathe.llm.common import cut


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 100) -> DataFrame:
    """``(node, root)`` for every node with an edge to another node; ``root``
    is the smallest node of its component.

    Every round rewrites the edges towards stars around the smallest node:
    large-star points each node's larger neighbours at its smallest neighbour,
    small-star points its smaller neighbours there. Both are one grouped
    minimum (combined before the shuffle) and one join with a single row per
    node on one side, so a hub's edges may be split over tasks. The edges are
    checkpointed each round; only a count and a checksum reach the driver.
    Self-loops, nulls and repeated edges are ignored.
    """
    u, v = F.col(a), F.col(b)
    e = edges.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct()
    e = cut(e)
    state = _state(e)
    for _ in range(max_rounds):
        if not state[0]:
            break
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("_m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("_m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("_m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("_m").alias("v")).where("u <> v")
        e = cut(small.union(low.select("u", F.col("_m").alias("v"))).distinct())
        before, state = state, _state(e)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
