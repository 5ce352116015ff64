"""Schemas of spans, messages and wire payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ANNOTATIONS = "array<struct<timestamp:bigint,value:string>>"

# One row per span.  IDs stay text: unsigned 64-bit numbers do not fit a bigint.
SPAN_FIELDS: dict[str, str] = {
    "trace_id": "string",
    "parent_id": "string",
    "id": "string",
    "kind": "string",
    "name": "string",
    "timestamp": "bigint",
    "duration": "bigint",
    "local_service": "string",
    "local_ipv4": "string",
    "local_ipv6": "string",
    "local_port": "int",
    "remote_service": "string",
    "remote_ipv4": "string",
    "remote_ipv6": "string",
    "remote_port": "int",
    "annotations": ANNOTATIONS,
    "tags": "map<string,string>",
    "debug": "boolean",
    "shared": "boolean",
    "transport": "string",
    "message_id": "string",
}

# What a span struct made while decoding one payload holds; routing columns come from the message.
DECODED_FIELDS = [name for name in SPAN_FIELDS if name not in ("transport", "message_id")]

# Schemas as DDL text, which readers take and which needs no session at import.
SPAN = ", ".join(f"`{n}` {t}" for n, t in SPAN_FIELDS.items())

QUEUE_MESSAGE = (
    "message_id string, receipt_handle string, transport string, body string, received_at timestamp"
)
STREAM_RECORD = (
    "message_id string, partition_key string, transport string, data binary, received_at timestamp"
)

_ENDPOINT = "struct<serviceName:string,ipv4:string,ipv6:string,port:int>"

# One schema covers both JSON layouts: the older one puts endpoints on its annotations.
WIRE_SPAN = (
    "struct<traceId:string,parentId:string,id:string,kind:string,name:string,"
    "timestamp:bigint,duration:bigint,"
    f"localEndpoint:{_ENDPOINT},remoteEndpoint:{_ENDPOINT},"
    f"annotations:array<struct<timestamp:bigint,value:string,endpoint:{_ENDPOINT}>>,"
    f"binaryAnnotations:array<struct<key:string,value:string,endpoint:{_ENDPOINT}>>,"
    "tags:map<string,string>,debug:boolean,shared:boolean>"
)
CORRUPT = "_unreadable"
WIRE_LIST = f"spans array<{WIRE_SPAN}>, {CORRUPT} string"

KINDS = ("CLIENT", "SERVER", "PRODUCER", "CONSUMER")


def empty_annotations() -> Column:
    return F.array().cast(ANNOTATIONS)


def empty_tags() -> Column:
    return F.create_map().cast("map<string,string>")


def conform(df: DataFrame) -> DataFrame:
    """Select the span columns in order, adding the absent ones as typed nulls."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(name) if name in present else F.lit(None)).cast(kind).alias(name)
            for name, kind in SPAN_FIELDS.items()
        ]
    )
