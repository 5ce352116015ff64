"""Spans as JSON list elements."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _endpoint(prefix: str) -> Column:
    parts = {"serviceName": "service", "ipv4": "ipv4", "ipv6": "ipv6", "port": "port"}
    known = F.coalesce(*[F.col(f"{prefix}_{c}").cast("string") for c in parts.values()])
    return F.when(
        known.isNotNull(), F.struct(*[F.col(f"{prefix}_{c}").alias(n) for n, c in parts.items()])
    )


def span_json() -> Column:
    """The JSON object of a span; null fields and empty collections are left out."""
    return F.to_json(
        F.struct(
            F.col("trace_id").alias("traceId"),
            F.col("parent_id").alias("parentId"),
            F.col("id"),
            F.col("kind"),
            F.col("name"),
            F.col("timestamp"),
            F.col("duration"),
            _endpoint("local").alias("localEndpoint"),
            _endpoint("remote").alias("remoteEndpoint"),
            F.when(F.size("annotations") > 0, F.col("annotations")).alias("annotations"),
            F.when(F.size("tags") > 0, F.col("tags")).alias("tags"),
            F.when(F.col("debug"), F.lit(True)).alias("debug"),
            F.when(F.col("shared"), F.lit(True)).alias("shared"),
        )
    )
