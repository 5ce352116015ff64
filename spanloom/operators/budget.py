"""Sampling of whole traces to a budget: so many per service and stretch of time, with weights.

Of each group the traces with the smallest hashes stay (bottom-k).  The decision is one per trace, by its first
span, so traces stay whole.  The next hash is the group's *threshold*: a trace stays with the probability that
its hash lies below it, and weighs one over that, so weighted counts over any part of the traces are
unbiased.  A group within its budget stays whole, with weight one.

What a group needs is its ``budget + 1`` smallest hashes, which can be merged: each task sends that many rows of
a group, a hot service too, and tables of earlier runs are merged in the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions.ids import digest_number

#: Hashes are 60 bits of a digest.
HASHES = float(1 << 60)
GROUP = ["service", "slot"]
#: Spark cuts a group to its first rows in each task, before the shuffle, for up to so many rows; groups of larger
#: budgets go through so many parts.
LIMITED_BEFORE_SHUFFLE, PARTS = 1000, 64


def trace_groups(spans: DataFrame, seconds: int = 1) -> DataFrame:
    """``trace_id``, ``service``, ``slot`` (start in seconds), ``hash``: a row per trace.

    The first span decides: one without a parent before the others, then the earliest, then by ID, kind
    and service.  A trace whose deciding span has no timestamp or service is of the group with null there.
    """
    first = F.struct(
        F.col("parent_id").isNotNull().alias("inner"), F.col("timestamp").isNull().alias("undated"),
        "timestamp", "id", F.coalesce("kind", F.lit("")).alias("kind"),
        F.coalesce("local_service", F.lit("")).alias("named"), F.col("local_service").alias("service"),
    )
    found = spans.filter(F.col("trace_id").isNotNull()).groupBy("trace_id").agg(F.min(first).alias("first"))
    length = seconds * 1_000_000
    return found.select(
        "trace_id", F.col("first.service").alias("service"),
        (F.floor(F.col("first.timestamp") / length) * seconds).cast("bigint").alias("slot"),
        digest_number(F.col("trace_id")).alias("hash"),
    )


def smallest(groups: DataFrame, budget: int) -> DataFrame:
    """The ``budget + 1`` rows of each group with the smallest hashes, ``place`` 1 and up; each trace comes once."""
    if budget < 1:
        raise ValueError("budget must be at least 1")
    rows = groups.select("trace_id", *GROUP, "hash")
    if budget + 1 > LIMITED_BEFORE_SHUFFLE:
        # longer lists are not cut before the shuffle: parts of a group are, each in a task of its own
        part = F.pmod(F.xxhash64("trace_id"), F.lit(PARTS))
        rows = _first(rows.withColumn("part", part), [*GROUP, "part"], budget + 1).drop("part", "place")
    return _first(rows, GROUP, budget + 1)


def _first(rows: DataFrame, group: list[str], number: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy("hash", "trace_id")
    return rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= number)


def merge(first: DataFrame, second: DataFrame, budget: int) -> DataFrame:
    """``smallest`` of two tables together, from what ``smallest`` gave for each."""
    columns = ["trace_id", *GROUP, "hash"]
    return smallest(first.select(*columns).unionByName(second.select(*columns)).distinct(), budget)


def kept_traces(bottom: DataFrame, budget: int) -> DataFrame:
    """``trace_id``, ``service``, ``slot``, ``weight`` of the traces that stay, from ``smallest``."""
    whole = Window.partitionBy(*GROUP)
    threshold = F.max(F.when(F.col("place") == budget + 1, F.col("hash"))).over(whole)
    weight = F.coalesce(F.lit(HASHES) / threshold, F.lit(1.0))
    return bottom.withColumn("weight", weight).filter(F.col("place") <= budget).select(
        "trace_id", *GROUP, "weight"
    )


def sample_traces(spans: DataFrame, budget: int, seconds: int = 1) -> DataFrame:
    """The traces that stay, with their weights."""
    return kept_traces(smallest(trace_groups(spans, seconds), budget), budget)


def sample_spans(spans: DataFrame, budget: int, seconds: int = 1) -> DataFrame:
    """All spans of the traces that stay, with their ``weight``."""
    return spans.join(sample_traces(spans, budget, seconds).select("trace_id", "weight"), "trace_id")
