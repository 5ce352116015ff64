"""Queue messages and stream records from files, in batch or as a stream.

Any other source with a text or binary value column plugs into the same operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom import schema
from spanloom.operators import ingest


def _load(reader, kind: str, path: str, fields):
    if kind == "text":
        return reader.format("text").load(path)
    return reader.schema(fields).format(kind).load(path)


def _as_messages(raw: DataFrame, kind: str, transport: str) -> DataFrame:
    if kind != "text":
        return raw
    # a line is a body and brings nothing else; its digest stands in for the message ID
    body = F.col("value")
    return raw.select(
        F.md5(body.cast("binary")).alias("message_id"),
        F.lit(None).cast("string").alias("receipt_handle"),
        F.lit(transport).alias("transport"),
        body.alias("body"),
        F.lit(None).cast("timestamp").alias("received_at"),
    )


def read_queue_messages(
    spark: SparkSession, path: str, kind: str = "parquet", transport: str = "sqs"
) -> DataFrame:
    """Text messages from ``parquet``, ``json`` or ``text`` files (one body per line)."""
    return _as_messages(_load(spark.read, kind, path, schema.QUEUE_MESSAGE), kind, transport)


def stream_queue_messages(
    spark: SparkSession, path: str, kind: str = "parquet", transport: str = "sqs",
    max_batch: int | None = None,
) -> DataFrame:
    """The same as a stream; ``max_batch`` bounds the files of one micro-batch."""
    reader = _bounded(spark, max_batch)
    return _as_messages(_load(reader, kind, path, schema.QUEUE_MESSAGE), kind, transport)


def read_stream_records(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame:
    """Binary records."""
    return _load(spark.read, kind, path, schema.STREAM_RECORD)


def stream_stream_records(
    spark: SparkSession, path: str, kind: str = "parquet", max_batch: int | None = None
) -> DataFrame:
    return _load(_bounded(spark, max_batch), kind, path, schema.STREAM_RECORD)


def _bounded(spark: SparkSession, max_batch: int | None):
    reader = spark.readStream
    return reader if max_batch is None else reader.option("maxFilesPerTrigger", max_batch)


def from_value(df: DataFrame, value: Column, transport: str) -> DataFrame:
    """Records from any source that delivers bytes in a column."""
    return df.select(
        F.md5(value).alias("message_id"),
        F.lit(None).cast("string").alias("partition_key"),
        F.lit(transport).alias("transport"),
        value.alias("data"),
        F.lit(None).cast("timestamp").alias("received_at"),
    )


def read_all_spans(*routed: DataFrame) -> DataFrame:
    """The spans of several routed sources together."""
    first, *others = [ingest.decode_spans(r) for r in routed]
    for spans in others:
        first = first.unionByName(spans)
    return first
