"""Writers.  None of them repartitions: packed messages come out of their aggregate well spread."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom import session
from spanloom.functions.segment import datagram


def write_queue_messages(messages: DataFrame, path: str, kind: str = "parquet") -> None:
    messages.write.mode("overwrite").format(kind).save(path)


def write_stream_records(records: DataFrame, path: str) -> None:
    """Every record carries its partition key; a busy key stays spread over many files."""
    records.write.mode("overwrite").parquet(path)


def write_oversize(oversize: DataFrame, path: str) -> None:
    """Quarantine of spans too large for any message: identity, size and the whole JSON text."""
    whole = oversize.select("pack_key", "trace_id", "id", "kind", "size", "json")
    with session.dropping_shuffles(oversize.sparkSession):
        whole.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_segments(documents: DataFrame, path: str) -> None:
    """One datagram per document: the header line, then the document line; files are gzipped, as documents repeat much."""
    lines = documents.select(datagram(F.col("document")).alias("value"))
    lines.write.mode("overwrite").option("compression", "gzip").text(path)
