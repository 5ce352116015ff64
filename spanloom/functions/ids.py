"""Trace and span identifiers as lower-case hexadecimal text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_id(c: Column) -> Column:
    """64-bit ID: lower case, padded to 16 digits."""
    return F.lpad(F.lower(c), 16, "0")


def normalize_trace_id(c: Column) -> Column:
    """64- or 128-bit ID: lower case, padded to 16 digits, or to 32 when longer than 16."""
    return F.lpad(F.lower(c), F.when(F.length(c) > 16, F.lit(32)).otherwise(F.lit(16)), F.lit("0"))


def is_trace_id(c: Column) -> Column:
    return F.coalesce(c.rlike("^[0-9a-fA-F]{1,32}$"), F.lit(False))


def is_span_id(c: Column) -> Column:
    return F.coalesce(c.rlike("^[0-9a-fA-F]{1,16}$"), F.lit(False))


def hex_id(c: Column) -> Column:
    """A long as 16 hexadecimal digits (two's complement for negatives)."""
    return F.lower(F.lpad(F.hex(c), 16, "0"))


def derived_id(*parts: Column) -> Column:
    """A repeatable 64-bit span ID made from the parts that identify a log entry."""
    return F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 16)


def derived_trace_id(epoch_seconds: Column, *parts: Column) -> Column:
    """A repeatable 128-bit trace ID whose first 8 digits are epoch seconds."""
    return F.concat(
        F.lower(F.lpad(F.hex(epoch_seconds), 8, "0")),
        F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 24),
    )


def digest_number(*parts: Column) -> Column:
    """A non-negative bigint that depends only on the text of the parts (60 bits of md5)."""
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
