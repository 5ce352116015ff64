"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.common import stored


def _to_minimum(links: DataFrame) -> DataFrame:
    """Per node ``u`` the smallest of itself and its neighbours, written so that the join that
    follows starts from a scan and adaptive execution may split a node with many links."""
    lowest = links.groupBy("u").agg(F.min("v").alias("low"))
    return stored(lowest.select(F.col("u").alias("node"), F.least("u", "low").alias("low")), "lowest")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_to_minimum(both), F.col("u") == F.col("node"))
    return joined.filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Links point from the larger node ``u`` to the smaller ``v``."""
    lowest = _to_minimum(links)
    joined = links.join(lowest, F.col("u") == F.col("node")).filter(F.col("v") != F.col("low"))
    moved = joined.select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.union(lowest.select(F.col("node").alias("u"), F.col("low").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of a link ``(u, v)`` that is not the root of its component.

    Large and small stars take turns until nothing moves; the root is the smallest node.  Every
    round is one aggregate and one join per star on tables in the shared folder; only two numbers
    come to the driver.  Links of a node with itself and repeated links are ignored.
    """
    ordered = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    links = stored(ordered.filter("u != v").distinct(), "links")
    before = _state(links)
    while before[0]:
        links = stored(_small_star(_large_star(links)).filter("u != v"), "links")
        after = _state(links)
        if after == before:
            break
        before = after
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)
