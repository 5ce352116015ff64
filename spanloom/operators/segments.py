"""Spans to segments: rejects, defaults, flattened fields and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions import segment as s

SHORT_TRACE_ID, BAD_STATUS = "trace_id_not_128_bit", "status_not_a_number"


def reject_reason() -> Column:
    """Why a span cannot become a segment; null when it can.  Reads prepared spans."""
    short = F.coalesce(F.length("trace_id") != s.TRACE_ID_LENGTH, F.lit(True))
    return F.when(short, F.lit(SHORT_TRACE_ID)).when(~s.status_is_number(), F.lit(BAD_STATUS))


def require_128bit_trace_id(spans: DataFrame) -> DataFrame:
    return spans.filter(F.length("trace_id") == s.TRACE_ID_LENGTH)


def quarantined(spans: DataFrame) -> DataFrame:
    """The spans that cannot become segments, with the reason."""
    marked = s.prepared(spans).withColumn("reason", reject_reason())
    return marked.filter(F.col("reason").isNotNull()).select(*spans.columns, "reason")


def default_sdk_tag(spans: DataFrame, sdk: str = s.REPORTER_SDK) -> DataFrame:
    """Name the reporting library where the span does not."""
    tags = F.coalesce(F.col("tags"), F.create_map().cast("map<string,string>"))
    return spans.withColumn(
        "tags",
        F.when(F.map_contains_key(tags, s.SDK_TAG), tags).otherwise(
            F.map_concat(tags, F.create_map(F.lit(s.SDK_TAG), F.lit(sdk)))
        ),
    )


def segment_columns(spans: DataFrame) -> DataFrame:
    """Segments of all encodable spans: scalar fields as columns, annotation and metadata maps."""
    return s.prepared(spans).filter(reject_reason().isNull()).select(
        "trace_id",
        "id",
        s.trace_id().alias("xray_trace_id"),
        "parent_id",
        s.segment_type().alias("type"),
        s.namespace().alias("namespace"),
        s.name().alias("name"),
        s.start_time().alias("start_time"),
        s.end_time().alias("end_time"),
        s.in_progress().alias("in_progress"),
        s.http_method().alias("http_method"),
        s.tag(s.HTTP_TAGS["url"]).alias("http_url"),
        s.http_status().alias("http_status"),
        s.status_class().alias("status_class"),
        *[s.tag(t).alias(f"sql_{f}") for f, t in s.SQL_TAGS.items()],
        s.sdk().alias("sdk"),
        *[s.tag(t).alias(f"aws_{f}") for f, t in s.AWS_TAGS.items()],
        *[s.tag(t).alias(f"ec2_{f}") for f, t in s.EC2_TAGS.items()],
        s.origin().alias("origin"),
        s.annotations().alias("annotations"),
        s.metadata().alias("metadata"),
    )


def segment_entries(spans: DataFrame, entries: Column) -> DataFrame:
    """Annotations or metadata as one row per entry."""
    return s.prepared(spans).select("trace_id", "id", F.explode(entries).alias("key", "value"))


def segment_documents(spans: DataFrame) -> DataFrame:
    """One document per encodable span; ``broken_exceptions`` marks those that lost a field."""
    return s.prepared(spans).filter(reject_reason().isNull()).select(
        "trace_id",
        "id",
        s.document().alias("document"),
        s.has_broken_exceptions().alias("broken_exceptions"),
    )


def report(spans: DataFrame) -> DataFrame:
    """Every span with its document to send, or the ``reason`` why it has none, in one pass.

    Write it once and split what was written with ``sent`` and ``left_out``.
    """
    marked = s.prepared(default_sdk_tag(spans)).withColumn("reason", reject_reason())
    encodable = F.col("reason").isNull()
    return marked.select(
        *spans.columns, "reason",
        F.when(encodable, s.document()).alias("document"),
        F.when(encodable, s.has_broken_exceptions()).alias("broken_exceptions"),
    )


def sent(reported: DataFrame) -> DataFrame:
    """What the reporter sends."""
    return reported.filter(F.col("reason").isNull()).select(
        "trace_id", "id", "document", "broken_exceptions"
    )


def left_out(reported: DataFrame) -> DataFrame:
    """What it has to leave out, with the reason."""
    return reported.filter(F.col("reason").isNotNull()).drop("document", "broken_exceptions")
