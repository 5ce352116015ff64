"""Spans from a log of SDK calls.

The log has one row per attempt: ``call_id``, ``attempt_no`` (rising within a call), ``service``,
``request_class``, ``trace_id``/``parent_id`` (the caller's context, null for a new root),
``send_ts``, ``recv_ts``, ``status``, ``request_id``; optionally ``error``, what the SDK reported, with
``has_cause``, ``is_service_error`` and ``error_message``, and the sampling facts ``sampled`` (the
caller's decision) and ``request_rule`` (that of a rule on the request).

Only sampled calls become spans, annotations or events: inherited from the caller, else by the request
rule, else by ``rate`` on the trace ID.  In a log without ``sampled`` a call with a caller is sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom import schema
from spanloom.functions import calls as call_fields
from spanloom.functions import ids, sampling

# Fixed values of the call instrumentation.
LOCAL_SPAN_NAME = "aws-sdk"
SENT, RECEIVED = "ws", "wr"

# The same for all attempts of a call; grouping by them spares an aggregate over text.
CALL_COLUMNS = ["call_id", "service", "request_class", "trace_id", "parent_id"]

_EVENT = "struct<timestamp:bigint,attempt_no:bigint,phase:int,status:int>"


def _operation() -> Column:
    return call_fields.operation_name(F.col("request_class"))


def _tags(columns: dict[str, Column]) -> Column:
    """A tag map without the entries whose value is null."""
    pairs = [x for k, v in columns.items() for x in (F.lit(k), v)]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())


def _status_tags(status: Column, error: Column) -> dict[str, Column]:
    """What was reported as an error, such as a lost connection, says more than the status."""
    text = status.cast("string")
    return {
        "http.status_code": F.when((status < 200) | (status > 299), text),
        "error": F.coalesce(error, F.when(status >= 400, text)),
    }


def _error(log: DataFrame) -> Column:
    return F.col("error") if "error" in log.columns else F.lit(None).cast("string")


def _real_error(log: DataFrame) -> Column:
    """Without what only repeats a status, where the log tells."""
    facts = ["has_cause", "is_service_error", "error_message"]
    if not set(facts) <= set(log.columns):
        return _error(log)
    return call_fields.keep_real_error(_error(log), *map(F.col, facts))


def with_call_context(attempts: DataFrame) -> DataFrame:
    """Give calls without a caller their own trace, derived so that runs repeat."""
    fresh = ids.derived_trace_id(F.lit(0).cast("bigint"), F.lit("call"), F.col("call_id"))
    own_root = F.col("trace_id").isNull()
    return attempts.withColumn(
        "parent_id", F.when(~own_root, F.col("parent_id"))
    ).withColumn("trace_id", F.coalesce("trace_id", fresh))


def sampled_calls(attempts: DataFrame, rate: float = 1.0) -> DataFrame:
    """The attempts of sampled calls, with their trace; nothing is grouped."""

    def fact(name: str, otherwise: Column) -> Column:
        return F.col(name) if name in attempts.columns else otherwise

    inherited = fact("sampled", F.when(F.col("trace_id").isNotNull(), F.lit(True)))
    log = with_call_context(attempts.withColumn("_inherited", inherited))
    decision = sampling.deferred_root_decision(
        F.col("trace_id"), fact("request_rule", F.lit(None).cast("boolean")), rate, F.col("_inherited")
    )
    return log.filter(decision).drop("_inherited")


def call_span_id() -> Column:
    return ids.derived_id(F.lit("call"), F.col("call_id"))


def sdk_call_spans(
    attempts: DataFrame, extra_tags: dict[str, Column] | None = None, rate: float = 1.0
) -> DataFrame:
    """A local span per call and a client span per attempt.

    ``extra_tags`` are columns over the log that become tags of the client spans.

    The call level is one aggregation with partial results in every task; attempts are projected
    one by one, so a call with many attempts is never gathered anywhere.
    """
    log = sampled_calls(attempts, rate)
    operation = _operation()
    error = _error(log)
    last = F.max(F.struct("attempt_no", "recv_ts", "status", error.alias("error")))
    per_call = log.groupBy(*CALL_COLUMNS).agg(F.min("send_ts").alias("timestamp"), last.alias("last"))
    failed = _status_tags(F.col("last.status"), F.col("last.error"))["error"]
    local = per_call.select(
        "trace_id",
        "parent_id",
        call_span_id().alias("id"),
        F.lit(LOCAL_SPAN_NAME).alias("name"),
        "timestamp",
        (F.col("last.recv_ts") - F.col("timestamp")).alias("duration"),
        _tags({
            "aws.service_name": F.col("service"), "aws.operation": operation, "error": failed,
        }).alias("tags"),
    )
    client = log.select(
        "trace_id",
        call_span_id().alias("parent_id"),
        ids.derived_id(F.col("call_id"), F.col("attempt_no")).alias("id"),
        F.lit("CLIENT").alias("kind"),
        operation.alias("name"),
        F.col("send_ts").alias("timestamp"),
        (F.col("recv_ts") - F.col("send_ts")).alias("duration"),
        F.col("service").alias("remote_service"),
        _tags({
            "aws.request_id": F.col("request_id"), **_status_tags(F.col("status"), error),
            **(extra_tags or {}),
        }).alias("tags"),
    )
    return schema.conform(local).unionByName(schema.conform(client))


def _events() -> tuple[Column, Column]:
    sent = F.struct("send_ts", "attempt_no", F.lit(0), F.lit(None))
    received = F.struct("recv_ts", "attempt_no", F.lit(1), "status")
    return sent.cast(_EVENT), received.cast(_EVENT)


def call_events(attempts: DataFrame, rate: float = 1.0) -> DataFrame:
    """The log as separate send and receive events, the form in which they arrive on a stream."""
    sent, received = _events()
    events = F.when(F.col("recv_ts").isNull(), F.array(sent)).otherwise(F.array(sent, received))
    return sampled_calls(attempts, rate).select(*CALL_COLUMNS, F.explode(events).alias("event"))


def event_parts(events: DataFrame, *more_keys: Column) -> DataFrame:
    """What the events of a call say, in a row: the first time and the last event."""
    last = F.struct("event.attempt_no", "event.phase", "event.timestamp", "event.status")
    return events.groupBy(*more_keys, *CALL_COLUMNS).agg(
        F.min("event.timestamp").alias("timestamp"), F.max(last).alias("last")
    )


def merge_parts(parts: DataFrame) -> DataFrame:
    """One row per call from parts of its events, in whatever order they were made."""
    return parts.groupBy(*CALL_COLUMNS).agg(
        F.min("timestamp").alias("timestamp"), F.max("last").alias("last")
    )


def event_spans(events: DataFrame, *more_keys: Column) -> DataFrame:
    """Client spans from send and receive events, one per call (and value of ``more_keys``).

    Only partial aggregates move.
    """
    return part_spans(event_parts(events, *more_keys))


def part_spans(per_call: DataFrame) -> DataFrame:
    """Client spans of calls, each a row of ``event_parts`` or ``merge_parts``."""
    finished = F.col("last.phase") == 1
    status = F.when(finished, F.col("last.status"))
    duration = F.when(finished, F.col("last.timestamp") - F.col("timestamp"))
    return _client_span(per_call, duration, status, F.lit(None).cast("string"))


def _client_span(
    per_call: DataFrame, duration: Column, status: Column, error: Column,
    extra_tags: dict[str, Column] | None = None,
) -> DataFrame:
    operation = _operation()
    spans = per_call.select(
        "trace_id",
        "parent_id",
        call_span_id().alias("id"),
        F.lit("CLIENT").alias("kind"),
        operation.alias("name"),
        "timestamp",
        duration.alias("duration"),
        F.col("service").alias("remote_service"),
        schema.empty_annotations().alias("annotations"),
        _tags({
            "aws.service_name": F.col("service"), "aws.operation": operation,
            **_status_tags(status, error), **(extra_tags or {}),
        }).alias("tags"),
    )
    return schema.conform(spans)


def sdk_operation_spans(
    attempts: DataFrame, extra_tags: dict[str, Column] | None = None, rate: float = 1.0
) -> DataFrame:
    """One client span per call, from partial aggregates whatever its number of attempts.

    Retries show as repeated send and receive annotations: the rows of ``call_annotations`` with the
    trace ID and ID of the span.  ``extra_tags`` are columns over the log; the last attempt's count.
    """
    log = sampled_calls(attempts, rate)
    extra = [c.cast("string").alias(f"extra{i}") for i, c in enumerate((extra_tags or {}).values())]
    per_call = log.groupBy(*CALL_COLUMNS).agg(
        F.min("send_ts").alias("timestamp"),
        F.max(F.struct(
            "attempt_no", "recv_ts", "status", _real_error(log).alias("error"), *extra
        )).alias("last"),
    )
    finished = F.col("last.recv_ts").isNotNull()
    return _client_span(
        per_call,
        F.when(finished, F.col("last.recv_ts") - F.col("timestamp")),
        F.when(finished, F.col("last.status")),
        F.col("last.error"),
        {name: F.col(f"last.extra{i}") for i, name in enumerate(extra_tags or {})},
    )


def call_annotations(attempts: DataFrame, rate: float = 1.0) -> DataFrame:
    """Send and receive annotations as rows: nothing is gathered, however long a call is."""
    return call_events(attempts, rate).select(
        "trace_id", call_span_id().alias("id"), F.col("event.timestamp").alias("timestamp"),
        F.when(F.col("event.phase") == 0, SENT).otherwise(RECEIVED).alias("value"),
    )
