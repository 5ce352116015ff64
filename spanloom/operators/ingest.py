"""Messages to spans: unwrap, detect, decode, validate, route.

Batch and streaming use the same functions.  Nothing here shuffles, and each payload is parsed
once: the parsed list is a column that validity, routing, counting and exploding all read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom import schema
from spanloom.functions import ids, payload, sampling

ACCEPTED, SKIPPED, RETRY = "accepted", "skipped", "retry"
MALFORMED, UNDECODABLE, UNSUPPORTED = "malformed", "undecodable", "unsupported_format"

# Older layout: annotation value to span kind, and the address keys naming the remote end.
CORE_KINDS = {
    "cs": "CLIENT", "cr": "CLIENT", "sr": "SERVER", "ss": "SERVER",
    "ms": "PRODUCER", "mr": "CONSUMER",
}
ADDRESS_KEYS = ("sa", "ca", "ma")
LOCAL_COMPONENT = "lc"


def skip_empty_bodies(messages: DataFrame) -> DataFrame:
    return messages.filter(~payload.is_empty_body(F.col("body")))


def unwrap(messages: DataFrame) -> DataFrame:
    """Add ``payload`` and ``format`` to text messages."""
    bytes_ = F.when(~payload.is_empty_body(F.col("body")), payload.decode_transport(F.col("body")))
    unwrapped = messages.withColumn("payload", bytes_)
    return unwrapped.withColumn("format", payload.payload_format(F.col("payload")))


def unwrap_records(records: DataFrame) -> DataFrame:
    """Binary records need no unwrapping: the data is the payload."""
    return records.withColumn("payload", F.col("data")).withColumn(
        "format", payload.payload_format(F.col("data"))
    )


def parse_payloads(unwrapped: DataFrame) -> DataFrame:
    """Add ``wire_spans``: the elements of a readable payload in which *every* element is valid.

    The list is parsed inside an object so that one unreadable element marks the whole payload.
    """
    text = F.when(F.col("format") == "json", payload.payload_text(F.col("payload")))
    wrapped = F.concat(F.lit('{"spans":'), text, F.lit("}"))
    parsed = unwrapped.withColumn(
        "_parsed",
        F.from_json(wrapped, schema.WIRE_LIST, {"columnNameOfCorruptRecord": schema.CORRUPT}),
    )
    spans = F.col("_parsed.spans")
    valid = F.col(f"_parsed.{schema.CORRUPT}").isNull() & F.forall(spans, _is_valid_element)
    return parsed.withColumn("wire_spans", F.when(valid, spans)).drop("_parsed")


def _is_valid_element(e: Column) -> Column:
    return (
        e.isNotNull()
        & ids.is_trace_id(e["traceId"])
        & ids.is_span_id(e["id"])
        & (e["parentId"].isNull() | ids.is_span_id(e["parentId"]))
        & (e["kind"].isNull() | e["kind"].isin(*schema.KINDS))
    )


def route_messages(parsed: DataFrame, storage_error: Column | None = None) -> DataFrame:
    """Add ``outcome``, ``counted`` and ``delete``.

    ``storage_error`` is what the sink said about the message: null for success,
    ``illegal_argument`` for data it will never take, anything else for a failure worth a retry.
    Skipped and retried messages stay in the queue.
    """
    empty = payload.is_empty_body(F.col("body")) if "body" in parsed.columns else F.lit(False)
    failed = F.lit(None).cast("string") if storage_error is None else storage_error
    outcome = (
        F.when(empty, F.lit(SKIPPED))
        .when(F.col("payload").isNull(), F.lit(UNDECODABLE))
        .when(F.col("format") == "binary", F.lit(UNSUPPORTED))
        .when(F.col("wire_spans").isNull(), F.lit(MALFORMED))
        .when(failed == "illegal_argument", F.lit(MALFORMED))
        .when(failed.isNotNull(), F.lit(RETRY))
        .otherwise(F.lit(ACCEPTED))
    )
    routed = parsed.withColumn("outcome", outcome)
    return routed.withColumn(
        "counted", ~F.col("outcome").isin(SKIPPED, UNDECODABLE)
    ).withColumn("delete", ~F.col("outcome").isin(SKIPPED, RETRY))


def ingest_messages(messages: DataFrame, storage_error: Column | None = None) -> DataFrame:
    """Queue messages with their outcome and parsed spans."""
    return route_messages(parse_payloads(unwrap(messages)), storage_error)


def ingest_records(records: DataFrame) -> DataFrame:
    """Stream records with their outcome and parsed spans; failures are counted, never retried."""
    return route_messages(parse_payloads(unwrap_records(records)))


def decode_spans(routed: DataFrame) -> DataFrame:
    """One row per span of each accepted message, whichever JSON layout it used."""
    elements = _explode_elements(routed)
    spans = elements.select(
        "transport", "message_id",
        F.inline(F.when(_is_v1(F.col("e")), _v1_spans(F.col("e"))).otherwise(
            F.array(_v2_span(F.col("e")))
        )),
    )
    return schema.conform(spans)


def decode_spans_v2(routed: DataFrame) -> DataFrame:
    """Current layout only: a plain projection of the exploded elements."""
    e = F.col("e")
    spans = _explode_elements(routed).filter(~_is_v1(e)).select(
        "transport", "message_id", _v2_span(e).alias("span")
    )
    return schema.conform(spans.select("transport", "message_id", "span.*"))


def decode_spans_v1(routed: DataFrame) -> DataFrame:
    """Older layout only; an element seen from both ends gives two rows."""
    spans = _explode_elements(routed).filter(_is_v1(F.col("e"))).select(
        "transport", "message_id", F.inline(_v1_spans(F.col("e")))
    )
    return schema.conform(spans)


def _explode_elements(routed: DataFrame) -> DataFrame:
    accepted = F.when(F.col("outcome") == ACCEPTED, F.col("wire_spans"))
    return routed.select("transport", "message_id", F.explode(accepted).alias("e"))


def _is_v1(e: Column) -> Column:
    has_endpoint = F.exists(
        F.coalesce(e["annotations"], F.array()), lambda a: a["endpoint"].isNotNull()
    )
    return e["binaryAnnotations"].isNotNull() | has_endpoint


def _identity(e: Column) -> dict[str, Column]:
    own, parent = ids.normalize_id(e["id"]), ids.normalize_id(e["parentId"])
    return {
        "trace_id": ids.normalize_trace_id(e["traceId"]),
        # a span is not its own parent
        "parent_id": F.when(parent != own, parent),
        "id": own,
    }


def _endpoint(prefix: str, ep: Column) -> dict[str, Column]:
    return {
        f"{prefix}_service": payload.empty_to_null(ep["serviceName"]),
        f"{prefix}_ipv4": ep["ipv4"],
        f"{prefix}_ipv6": ep["ipv6"],
        f"{prefix}_port": ep["port"],
    }


def _plain_annotations(annotations: Column) -> Column:
    events = F.transform(
        annotations, lambda a: F.struct(a["timestamp"].alias("timestamp"), a["value"].alias("value"))
    )
    return F.coalesce(events, schema.empty_annotations())


def _span_struct(fields: dict[str, Column]) -> Column:
    return F.struct(
        *[fields[n].cast(schema.SPAN_FIELDS[n]).alias(n) for n in schema.DECODED_FIELDS]
    )


def _v2_span(e: Column) -> Column:
    return _span_struct({
        **_identity(e),
        "kind": e["kind"],
        "name": e["name"],
        "timestamp": e["timestamp"],
        "duration": e["duration"],
        **_endpoint("local", e["localEndpoint"]),
        **_endpoint("remote", e["remoteEndpoint"]),
        "annotations": _plain_annotations(e["annotations"]),
        "tags": F.coalesce(
            F.map_filter(e["tags"], lambda _, v: v.isNotNull()), schema.empty_tags()
        ),
        "debug": e["debug"],
        "shared": e["shared"],
    })


def _v1_spans(e: Column) -> Column:
    """The client-side, server-side, messaging or local spans one older element describes."""
    notes = F.coalesce(e["annotations"], F.array())
    binary = F.coalesce(e["binaryAnnotations"], F.array())
    identity = _identity(e)

    def first(value: str) -> Column:
        return F.get(F.filter(notes, lambda a: a["value"] == value), 0)

    def address(*keys: str) -> Column:
        return F.get(F.filter(binary, lambda b: b["key"].isin(*keys)), 0)["endpoint"]

    used = list(CORE_KINDS)
    rest = {
        "name": e["name"],
        "annotations": _plain_annotations(F.filter(notes, lambda a: ~a["value"].isin(used))),
        "tags": F.map_from_entries(F.transform(
            F.filter(
                binary,
                lambda b: ~b["key"].isin(*ADDRESS_KEYS, LOCAL_COMPONENT) & b["value"].isNotNull(),
            ),
            lambda b: F.struct(b["key"], b["value"]),
        )),
        "debug": e["debug"],
    }

    def side(kind: str, begin: Column, end: Column, remote: Column, shared: Column) -> Column:
        started = F.coalesce(begin["timestamp"], end["timestamp"])
        # when two rows share an element its own times belong to the client side
        own = F.lit(True) if kind != "SERVER" else ~shared
        endpoint = F.coalesce(begin["endpoint"], end["endpoint"])
        return F.when(
            begin.isNotNull() | end.isNotNull(),
            _span_struct({
                **identity,
                **rest,
                "kind": F.lit(kind),
                "timestamp": F.coalesce(F.when(own, e["timestamp"]), started),
                "duration": F.coalesce(
                    F.when(own, e["duration"]), end["timestamp"] - begin["timestamp"]
                ),
                **_endpoint("local", endpoint),
                **_endpoint("remote", remote),
                "shared": F.when(shared, F.lit(True)),
            }),
        )

    nothing = F.lit(None)
    no_end = F.filter(notes, lambda a: F.lit(False))
    absent = F.get(no_end, 0)
    client_seen = first("cs").isNotNull() | first("cr").isNotNull()
    sides = F.array_compact(F.array(
        side("CLIENT", first("cs"), first("cr"), address("sa"), F.lit(False)),
        side("SERVER", first("sr"), first("ss"), address("ca"), client_seen),
        side("PRODUCER", first("ms"), absent, address("ma"), F.lit(False)),
        side("CONSUMER", first("mr"), absent, address("ma"), F.lit(False)),
    ))
    local = _span_struct({
        **identity,
        **rest,
        "kind": nothing,
        "timestamp": e["timestamp"],
        "duration": e["duration"],
        **_endpoint("local", F.coalesce(
            address(LOCAL_COMPONENT),
            F.get(F.filter(notes, lambda a: a["endpoint"].isNotNull()), 0)["endpoint"],
        )),
        **_endpoint("remote", address(*ADDRESS_KEYS)),
        "shared": nothing,
    })
    return F.when(F.size(sides) > 0, sides).otherwise(F.array(local))


def sample_traces(spans: DataFrame, rate: float) -> DataFrame:
    """Keep whole traces at the given rate, and every debug span."""
    return spans.filter(sampling.is_sampled(F.col("trace_id"), rate, F.col("debug")))
