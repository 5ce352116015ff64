"""Message bodies and binary payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bodies that hold no spans.
EMPTY_BODIES = ("", "[]")

STRICT_BASE64 = "^[A-Za-z0-9+/]*={0,2}$"


def is_empty_body(body: Column) -> Column:
    return body.isNull() | body.isin(*EMPTY_BODIES)


def decode_transport(body: Column) -> Column:
    """Payload bytes of a text body, or null when it is neither a JSON list nor base64."""
    return F.when(body.startswith("["), F.encode(body, "UTF-8")).when(
        body.rlike(STRICT_BASE64), F.try_to_binary(body, F.lit("base64"))
    )


def payload_format(payload: Column) -> Column:
    """``json`` when the first byte is ``[``, otherwise ``binary``; null for nothing at all."""
    return F.when(F.octet_length(payload) > 0,
                  F.when(F.substring(payload, 1, 1) == F.lit(b"["), F.lit("json"))
                  .otherwise(F.lit("binary")))


def payload_text(payload: Column) -> Column:
    """The payload as text, or null when it is not valid UTF-8."""
    text = payload.cast("string")
    return F.when(F.is_valid_utf8(text), text)


def encode_body(text: Column) -> Column:
    """Send JSON as it is when every byte is ASCII, as base64 otherwise."""
    return F.when(~text.rlike(r"[^\x00-\x7F]"), text).otherwise(
        F.base64(F.encode(text, "UTF-8"))
    )


def base64_size_estimate(list_bytes: Column) -> Column:
    """Upper estimate of a base64 message for a span list of that many bytes (integer arithmetic)."""
    return F.floor((list_bytes + 2) * 4 / 3).cast("bigint")


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 code units, where characters outside the basic plane count twice."""
    return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("int")


def utf16_shorter(text: Column, limit: int) -> Column:
    """Whether the UTF-16 length is below a limit; only doubtful texts are encoded to find out."""
    return (
        F.when(F.octet_length(text) < limit, F.lit(True))
        .when(F.length(text) >= limit, F.lit(False))
        .otherwise(utf16_length(text) < limit)
    )


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))
