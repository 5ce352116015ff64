"""Stateful jobs: duplicate deliveries, windowed counters, pairing of call events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spanloom.operators import calls, metrics
from spanloom.operators.dedup import SPAN_KEY, content_hash, keep_first
from spanloom.streaming.ingest import run

DEFAULT_DELAY = "10 minutes"
DEFAULT_TIMEOUT = "1 minute"

WINDOW_KEY = ["window_start", "window_end", "transport"]


def dedup_stream(spans: DataFrame, delay: str = DEFAULT_DELAY) -> DataFrame:
    """Drop spans that were delivered before, ``delay`` ago at most; that also bounds the state.

    Time is when a micro-batch arrives, not what a span says, so old spans and spans without a
    timestamp are never late.  A copy that comes later than ``delay`` stays.
    """
    timed = spans.withColumn("arrived", F.current_timestamp()).withColumn(
        "content", content_hash(spans.columns)
    )
    unique = timed.withWatermark("arrived", delay).dropDuplicatesWithinWatermark(
        [*SPAN_KEY, "content"]
    )
    return unique.drop("arrived", "content")


def metrics_stream(
    routed: DataFrame, delay: str = DEFAULT_DELAY, length: str = "10 minutes",
    slide: str | None = None,
) -> DataFrame:
    """Counters per transport and window; state holds one row per open window."""
    return metrics.metrics_by_window(
        routed.withWatermark("received_at", delay), "received_at", length, slide
    )


def pair_call_events(
    events: DataFrame, delay: str = DEFAULT_DELAY, timeout: str = DEFAULT_TIMEOUT
) -> DataFrame:
    """Client spans from send and receive events that arrive on their own.

    A table gives one span per call, whatever the gaps between its events.  On a stream a call is a
    session whose events lie less than ``timeout`` apart: once the watermark passes its end the span
    is emitted.  Without a last receive event a span has no duration, which is how an unfinished one
    looks.  State holds the first time and the last event of each open call, not its events; those
    are the annotations, as rows of their own.
    """
    if not events.isStreaming:
        return calls.event_spans(events)
    timed = events.withColumn("event_time", F.timestamp_micros(F.col("event.timestamp")))
    return calls.event_spans(
        timed.withWatermark("event_time", delay), F.session_window("event_time", timeout)
    )


def stream_call_parts(
    events: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Store what every micro-batch says about its calls, for ``stored_calls``.

    No state and no watermark: an event may come at any time after the others.
    """
    return _by_batch(events, path, checkpoint, available_now, calls.event_parts)


def stored_calls(spark: SparkSession, path: str) -> DataFrame:
    """Client spans of all calls seen so far, finished or not."""
    return calls.part_spans(calls.merge_parts(spark.read.parquet(path)))


def upsert_to(
    windows: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Store the windows that every micro-batch changed, open ones included, for ``newest``."""
    return _by_batch(windows, path, checkpoint, available_now)


def newest(spark: SparkSession, path: str, keys: list[str] | None = None) -> DataFrame:
    """The latest stored row of each window."""
    changed = spark.read.parquet(path)
    return keep_first(changed, keys or WINDOW_KEY, [F.col("batch").desc()]).drop("batch")


def _by_batch(df, path, checkpoint, available_now, change=lambda batch: batch) -> StreamingQuery:
    """A folder per micro-batch; one that is repeated overwrites its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        change(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return run(df, write, checkpoint, available_now, "update")


def append_to(df: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append finished rows as parquet; the file sink commits each micro-batch once."""
    writer = df.writeStream.format("parquet").outputMode("append").option(
        "checkpointLocation", checkpoint
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start(path)
