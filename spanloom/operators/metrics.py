"""Collector counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.payload import base64_size_estimate
from spanloom.operators.ingest import ACCEPTED


def counters() -> list[Column]:
    """Message, byte, drop and span counts over routed messages.

    Bytes are those of the unwrapped payload.  A message that could not be unwrapped is not counted
    at all; one that could not be decoded is counted and dropped.
    """
    counted = F.col("counted")
    accepted = F.col("outcome") == ACCEPTED
    return [
        F.count_if(counted).alias("messages"),
        F.coalesce(F.sum(F.when(counted, F.octet_length("payload").cast("bigint"))), F.lit(0))
        .cast("bigint").alias("bytes"),
        F.count_if(counted & ~F.col("outcome").isin(ACCEPTED, "retry")).alias("messages_dropped"),
        F.coalesce(F.sum(F.when(accepted, F.size("wire_spans").cast("bigint"))), F.lit(0))
        .cast("bigint").alias("spans"),
    ]


def collector_metrics(routed: DataFrame) -> DataFrame:
    """Counters per transport: partial counts in every task, then a handful of rows."""
    return routed.groupBy("transport").agg(*counters())


def observed(routed: DataFrame, name: str = "collector") -> DataFrame:
    """The same rows; counters of each query or micro-batch go to its listeners."""
    return routed.observe(name, *counters())


def metrics_by_window(
    routed: DataFrame, time: str = "received_at", length: str = "10 minutes",
    slide: str | None = None,
) -> DataFrame:
    """Counters per transport and event-time window; on a stream, set a watermark first."""
    span = F.window(time, length, slide) if slide else F.window(time, length)
    return (
        routed.groupBy(span.alias("window"), "transport").agg(*counters())
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "transport", "messages", "bytes", "messages_dropped", "spans",
        )
    )


def message_size(messages: DataFrame, group: list[str], list_bytes: str) -> DataFrame:
    """List bytes per group and the base64 size they would take."""
    return messages.groupBy(*group).agg(F.sum(list_bytes).alias("list_bytes")).withColumn(
        "size_estimate", base64_size_estimate(F.col("list_bytes"))
    )
