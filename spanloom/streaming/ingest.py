"""Endless ingest: receive, unwrap, decode, store.

A micro-batch that fails is run again from the checkpoint.  What may be deleted from the queue stands
in the outcomes, written last, so a message is acknowledged only once its spans are stored.  Every
micro-batch writes its own folders and overwrites them when it is repeated, so a retry leaves no second
copy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spanloom import schema
from spanloom.operators import ingest
from spanloom.operators.ingest import ACCEPTED

Sampler = Callable[[DataFrame], DataFrame]
Sink = Callable[[DataFrame, int], None]

_MESSAGE_COLUMNS = ["message_id", "transport", "outcome", "delete", "payload"]
# of queue messages; records have neither
_AS_RECEIVED = ["body", "receipt_handle"]
_HANDLE = "receipt_handle"


def write_outcomes(
    routed: DataFrame, batch_id: int, out: str, sampler: Sampler | None = None
) -> None:
    """Spans (those the sampler keeps), quarantine and counters of one micro-batch.

    The routed batch is read three times, so it is kept on the executors meanwhile; a lost block is
    simply computed again from the source.
    """
    part = f"batch={batch_id}"
    routed = routed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        spans = ingest.decode_spans(routed)
        kept = sampler(spans) if sampler else spans
        kept.write.mode("overwrite").parquet(f"{out}/spans/{part}")
        # a body that could not be unwrapped has no payload; it is kept as it came
        found = [*_MESSAGE_COLUMNS, *(c for c in _AS_RECEIVED if c in routed.columns)]
        rejected = routed.filter(F.col("outcome") != ACCEPTED).select(*found)
        rejected.write.mode("overwrite").parquet(f"{out}/quarantine/{part}")
        handle = F.col(_HANDLE) if _HANDLE in routed.columns else F.lit(None).cast("string")
        routed.select(
            "message_id", handle.alias(_HANDLE), "transport", "received_at", "outcome", "counted", "delete",
            F.octet_length("payload").alias("bytes"), F.size("wire_spans").alias("spans"),
        ).write.mode("overwrite").parquet(f"{out}/outcomes/{part}")
    finally:
        routed.unpersist()


def folder_sink(out: str, sampler: Sampler | None = None) -> Sink:
    """Parquet folders under ``out``."""
    return lambda batch, batch_id: write_outcomes(batch, batch_id, out, sampler)


def run(
    routed: DataFrame, sink: Sink, checkpoint: str, available_now: bool = False,
    mode: str = "append",
) -> StreamingQuery:
    """Hand every routed micro-batch to a sink; one that raises is handed over again on restart."""
    writer = routed.writeStream.foreachBatch(sink).outputMode(mode).option(
        "checkpointLocation", checkpoint
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stream_ingest(
    messages: DataFrame, out: str, checkpoint: str, available_now: bool = False,
    sampler: Sampler | None = None,
) -> StreamingQuery:
    """Queue messages to stored spans, quarantine and outcomes."""
    sink = folder_sink(out, sampler)
    return run(ingest.ingest_messages(messages), sink, checkpoint, available_now)


def stream_ingest_records(
    records: DataFrame, out: str, checkpoint: str, available_now: bool = False,
    sampler: Sampler | None = None,
) -> StreamingQuery:
    """Stream records likewise; what fails is counted and quarantined, not retried."""
    sink = folder_sink(out, sampler)
    return run(ingest.ingest_records(records), sink, checkpoint, available_now)


def stored_spans(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(schema.SPAN).parquet(f"{out}/spans").select(*schema.SPAN_FIELDS)


def stored_outcomes(spark: SparkSession, out: str) -> DataFrame:
    """Outcome rows with the number of the micro-batch that wrote them (``batch``)."""
    return spark.read.parquet(f"{out}/outcomes")


def acknowledgements(spark: SparkSession, out: str) -> DataFrame:
    """What became of every message, and whether its handle may be used to delete it."""
    return stored_outcomes(spark, out).select("message_id", _HANDLE, "outcome", "delete")


def stored_quarantine(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/quarantine")
