"""Spans and headers of queue publishes.

The log has one row per message: ``batch_id``, ``entry_id``, ``queue_url``, ``attributes`` (map),
``batch_ts``/``sent_ts`` (microseconds), ``scope`` (struct of trace_id, span_id, sampled: the span
in scope, or null) and ``local_service``.  All batch columns repeat on every entry, so entries find
their parent without a join.

Where headers travel can be chosen: ``carrier`` is the map column and ``names`` are the header names.
The first one that is present is read, all are cleared, and the first is written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom import schema
from spanloom.functions import calls as call_fields
from spanloom.functions import headers, ids, sampling

# Fixed values of the publish instrumentation.
PUBLISH, PUBLISH_BATCH = "publish", "publish-batch"
REMOTE_SERVICE = "amazon-sqs"
QUEUE_TAG = "queue.url"

CARRIER, NAMES = "attributes", (headers.HEADER_NAME,)

CONTEXT = "struct<trace_id:string,parent_id:string,sampled:boolean,custom:string>"


def resolve_parent(scope: Column, parsed: Column, new_trace_id: Column) -> Column:
    """Where a new span belongs: under the scope, else the header's context, else a new trace.

    A header that only carries a trace ID continues the trace without a parent; one that only
    carries flags keeps its sampling decision.
    """
    in_scope = F.struct(scope["trace_id"], scope["span_id"], scope["sampled"], F.lit(""))
    continued = F.struct(
        F.coalesce(parsed["root"], new_trace_id), parsed["parent"], parsed["sampled"],
        F.coalesce(parsed["custom"], F.lit("")),
    )
    return F.when(scope.isNotNull(), in_scope.cast(CONTEXT)).otherwise(continued.cast(CONTEXT))


def _seconds(micros: str) -> Column:
    return F.floor(F.col(micros) / 1_000_000).cast("bigint")


def _decided(context: Column, rate: float) -> Column:
    return F.coalesce(context["sampled"], sampling.is_sampled(context["trace_id"], rate))


def publish_contexts(
    messages: DataFrame, rate: float = 1.0, carrier: str = CARRIER, names: Sequence[str] = NAMES
) -> DataFrame:
    """Single publishes: add ``context`` (of the parent), ``span_id`` and ``sampled``."""
    # a scope goes before the header, which then says nothing
    header = F.when(F.col("scope").isNull(), F.coalesce(*[F.col(carrier)[name] for name in names]))
    fresh = ids.derived_trace_id(
        _seconds("sent_ts"), F.lit("message"), F.col("batch_id"), F.col("entry_id")
    )
    located = headers.with_parsed(messages, header, "_parsed").withColumn(
        "context", resolve_parent(F.col("scope"), F.col("_parsed"), fresh)
    )
    return _with_span(located.drop("_parsed"), rate)


def batch_contexts(messages: DataFrame, rate: float = 1.0) -> DataFrame:
    """Batch publishes: entries belong to the batch span and old headers are not read."""
    fresh = ids.derived_trace_id(_seconds("batch_ts"), F.lit("batch"), F.col("batch_id"))
    context = F.struct(
        F.coalesce(F.col("scope.trace_id"), fresh), batch_span_id(), F.col("scope.sampled"),
        F.lit(""),
    ).cast(CONTEXT)
    return _with_span(messages.withColumn("context", context), rate)


def batch_span_id() -> Column:
    return ids.derived_id(F.lit("batch"), F.col("batch_id"))


def _with_span(located: DataFrame, rate: float) -> DataFrame:
    return located.withColumn(
        "span_id", ids.derived_id(F.col("batch_id"), F.col("entry_id"))
    ).withColumn("sampled", _decided(F.col("context"), rate))


def message_spans(located: DataFrame) -> DataFrame:
    """A producer span without duration per message."""
    spans = located.select(
        F.col("context.trace_id").alias("trace_id"),
        F.col("context.parent_id").alias("parent_id"),
        F.col("span_id").alias("id"),
        F.lit("PRODUCER").alias("kind"),
        F.lit(PUBLISH).alias("name"),
        F.col("sent_ts").alias("timestamp"),
        F.lit(0).cast("bigint").alias("duration"),
        "local_service",
        F.lit(REMOTE_SERVICE).alias("remote_service"),
        F.create_map(F.lit(QUEUE_TAG), F.col("queue_url")).alias("tags"),
    )
    return schema.conform(spans)


def publish_spans(messages: DataFrame) -> DataFrame:
    """Spans of the sampled messages; headers are injected into the others as well."""
    return message_spans(publish_contexts(messages).filter("sampled"))


def publish_batch_spans(messages: DataFrame, legacy: bool = False) -> DataFrame:
    """A span per sampled batch above the spans of its messages.

    ``legacy`` leaves the kind of the batch span open, as the older instrumentation does.
    """
    located = batch_contexts(messages).filter("sampled")
    per_batch = located.groupBy(
        "batch_id", "batch_ts", "local_service",
        F.col("context.trace_id").alias("trace_id"),
        F.col("scope.span_id").alias("parent_id"),
    ).agg(F.max("sent_ts").alias("end_ts"))
    parents = per_batch.select(
        "trace_id",
        "parent_id",
        batch_span_id().alias("id"),
        F.lit(None if legacy else "PRODUCER").alias("kind"),
        F.lit(PUBLISH_BATCH).alias("name"),
        F.col("batch_ts").alias("timestamp"),
        (F.col("end_ts") - F.col("batch_ts")).alias("duration"),
        "local_service",
        F.lit(REMOTE_SERVICE).alias("remote_service"),
    )
    return schema.conform(parents).unionByName(message_spans(located))


def strip_trace_headers(
    messages: DataFrame, carrier: str = CARRIER, names: Sequence[str] = NAMES
) -> DataFrame:
    return messages.withColumn(carrier, call_fields.strip_headers(F.col(carrier), list(names)))


def inject_message_headers(
    located: DataFrame, carrier: str = CARRIER, names: Sequence[str] = NAMES
) -> DataFrame:
    """Replace each message's trace header by the one of its publish span."""
    header = headers.format_trace_header(
        F.col("context.trace_id"), F.col("span_id"), F.col("sampled"), F.col("context.custom")
    )
    cleared = call_fields.strip_headers(F.col(carrier), list(names))
    return located.withColumn(
        carrier, F.map_concat(cleared, F.create_map(F.lit(names[0]), header))
    )
