"""Duplicate deliveries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN_KEY = ["trace_id", "id", "kind"]
_CONTENT = [
    "parent_id", "name", "timestamp", "duration",
    "local_service", "local_ipv4", "local_ipv6", "local_port",
    "remote_service", "remote_ipv4", "remote_ipv6", "remote_port",
    "debug", "shared",
]


def content_hash(columns: list[str]) -> Column:
    """A number for what a span says, whichever message delivered it.

    Map entries are sorted first because their order is not part of the content.
    """
    parts = [F.col(c) for c in SPAN_KEY + _CONTENT if c in columns]
    if "tags" in columns:
        parts.append(F.sort_array(F.map_entries("tags")))
    if "annotations" in columns:
        parts.append(F.sort_array("annotations"))
    return F.xxhash64(*parts)


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Filtering ``row_number() = 1`` makes Spark keep one row per key in every task *before* the
    shuffle, so a key with a third of all rows sends one row per task and no hot partition forms.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def dedup_spans(spans: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per span: redelivered copies collapse, differing reports keep the earliest.

    The order is total up to rows with the same content.
    """
    order = [
        F.col("timestamp").asc_nulls_last(),
        F.col("duration").asc_nulls_last(),
        F.col("name").asc_nulls_last(),
        F.col("remote_service").asc_nulls_last(),
        content_hash(spans.columns).asc(),
    ]
    return keep_first(spans, keys or SPAN_KEY, order)
