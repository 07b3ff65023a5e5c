"""Connected components by alternating large-star and small-star steps over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workspace import Workspace


def _least_neighbour(links: DataFrame) -> DataFrame:
    """``a, b, least``: each link with the smallest of ``a`` and its neighbours, aggregated before the join."""
    least = links.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return links.join(least, "a")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _least_neighbour(both).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` point from the larger end ``a`` to the smaller ``b``."""
    least = _least_neighbour(links)
    across = least.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return across.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame, work: Workspace) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b``: longs, not null, a <> b); the root is the smallest node reached.

    Each round is two aggregations and joins on a node; no task holds a component. No links give no rows.
    """
    now = work.settle(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links-0")
    state, step = None, 0
    while True:
        sign = now.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0))).first()
        if (sign[0], sign[1]) == state or sign[0] == 0:
            break
        state, step = (sign[0], sign[1]), step + 1
        stars = work.settle(_large_star(now), f"stars-{step}")
        now = work.settle(_small_star(stars), f"links-{step}")
        work.drop(f"stars-{step}", f"links-{step - 1}")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
