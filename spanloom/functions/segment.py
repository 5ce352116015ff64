"""Segment fields of one span.

Everything here is a narrow projection over the span columns: no shuffle, no Python.
A section object exists as soon as *any* tag with its prefix is present, recognised or not.

Parts that several fields need are columns of ``prepared`` spans, so they are worked out once a row;
the functions that say so read them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.headers import format_root_id
from spanloom.functions.payload import utf16_shorter

# Fixed values of the segment format.
DATAGRAM_HEADER = '{"format": "json", "version": 1}'
SDK_TAG = "aws.xray.sdk"
DEFAULT_SDK = "Zipkin"
REPORTER_SDK = "Zipkin Brave"
NAMESPACE_TAG = "xray.namespace"
UNKNOWN_NAME = "unknown"
METADATA_LENGTH = 250
TRACE_ID_LENGTH = 32
HTTP_TAGS = {"method": "http.method", "url": "http.url", "status": "http.status_code"}
SQL_TAGS = {
    "url": "sql.url",
    "preparation": "sql.preparation",
    "database_type": "sql.database_type",
    "database_version": "sql.database_version",
    "driver_version": "sql.driver_version",
    "user": "sql.user",
    "sanitized_query": "sql.sanitized_query",
}
AWS_TAGS = {
    "operation": "aws.operation",
    "account_id": "aws.account_id",
    "region": "aws.region",
    "request_id": "aws.request_id",
    "queue_url": "aws.queue_url",
    "table_name": "aws.table_name",
}
EC2_TAGS = {
    "availability_zone": "aws.ec2.availability_zone",
    "instance_id": "aws.ec2.instance_id",
}
ORIGIN_TAG = "aws.origin"
CAUSE_TAGS = {
    "working_directory": "cause.working_directory",
    "exceptions": "cause.exceptions",
}

# Tags that fill a segment field and so never become annotations or metadata.
CONSUMED_TAGS = [
    *HTTP_TAGS.values(), *SQL_TAGS.values(), *AWS_TAGS.values(), *EC2_TAGS.values(),
    ORIGIN_TAG, SDK_TAG, *CAUSE_TAGS.values(),
]


def tag(name: str) -> Column:
    return F.col("tags")[name]


def has_section(prefix: str) -> Column:
    return F.coalesce(
        F.exists(F.map_keys("tags"), lambda k: k.startswith(prefix)), F.lit(False)
    )


def prepared(spans: DataFrame) -> DataFrame:
    """Add the shared parts: section flags, status, method, exceptions, and the leftover tags."""
    status = tag(HTTP_TAGS["status"])
    parts = spans.withColumns({
        "_has_http": has_section("http."),
        "_has_sql": has_section("sql."),
        "_has_cause": has_section("cause."),
        "_status": F.when(status.rlike("^[+-]?[0-9]+$"), status.try_cast("int")),
        "_exceptions": F.try_parse_json(tag(CAUSE_TAGS["exceptions"])),
        "_rest": F.map_filter("tags", lambda k, v: ~k.isin(CONSUMED_TAGS) & v.isNotNull()),
    })
    short = F.map_filter("_rest", lambda _, v: utf16_shorter(v, METADATA_LENGTH))
    long = F.map_filter("_rest", lambda _, v: ~utf16_shorter(v, METADATA_LENGTH))
    return parts.withColumns({
        # the method as tagged, else the span name; null unless there is an http section
        "_method": F.when(
            F.col("_has_http"), F.coalesce(tag(HTTP_TAGS["method"]), F.col("name"))
        ),
        "_short": _underscored(short),
        "_long": _underscored(long),
    })


def _underscored(tags: Column) -> Column:
    return F.transform_keys(tags, lambda k, _: F.replace(k, F.lit("."), F.lit("_")))


def calls_out() -> Column:
    return F.coalesce(F.col("kind").isin("CLIENT", "PRODUCER"), F.lit(False))


def trace_id() -> Column:
    return format_root_id(F.col("trace_id"))


def segment_type() -> Column:
    part_of_parent = F.col("kind").isNull() | calls_out()
    return F.when(F.col("parent_id").isNotNull() & part_of_parent, F.lit("subsegment"))


def namespace() -> Column:
    return F.coalesce(tag(NAMESPACE_TAG), F.when(calls_out(), F.lit("remote")))


def name() -> Column:
    return (
        F.when(F.col("kind").isNull(), F.coalesce(F.col("name"), F.lit(UNKNOWN_NAME)))
        .when(
            calls_out(),
            F.coalesce(
                F.col("remote_service"), tag("http.host"), F.col("name"), F.lit(UNKNOWN_NAME)
            ),
        )
        .otherwise(F.col("local_service"))
    )


def seconds(micros: Column) -> Column:
    return micros.cast("double") / F.lit(1_000_000.0)


def start_time() -> Column:
    return seconds(F.col("timestamp"))


def end_time() -> Column:
    return seconds(F.col("timestamp") + F.col("duration"))


def in_progress() -> Column:
    return F.when(F.col("timestamp").isNotNull() & F.col("duration").isNull(), F.lit(True))


def status_is_number() -> Column:
    """False only for a status tag that is not an integer.  Reads prepared spans."""
    return tag(HTTP_TAGS["status"]).isNull() | F.col("_status").isNotNull()


def http_method() -> Column:
    """Reads prepared spans."""
    return F.upper("_method")


def http_status() -> Column:
    """Reads prepared spans."""
    return F.col("_status")


def http() -> Column:
    """Reads prepared spans."""
    method, url, status = http_method(), tag(HTTP_TAGS["url"]), http_status()
    request = F.when(
        method.isNotNull() | url.isNotNull(), F.struct(method.alias("method"), url.alias("url"))
    )
    response = F.when(status.isNotNull(), F.struct(status.alias("status")))
    return F.when(
        F.col("_has_http"), F.struct(request.alias("request"), response.alias("response"))
    )


def status_class() -> Column:
    """``throttle``, ``fault`` or ``error``, at most one of them.  Reads prepared spans."""
    status = http_status()
    return (
        F.when(status == 429, F.lit("throttle"))
        .when(status >= 500, F.lit("fault"))
        .when(status >= 400, F.lit("error"))
    )


def status_flag(which: str) -> Column:
    return F.when(status_class() == which, F.lit(True))


def sql() -> Column:
    """Reads prepared spans."""
    return F.when(F.col("_has_sql"), F.struct(*[tag(t).alias(f) for f, t in SQL_TAGS.items()]))


def sdk() -> Column:
    return F.coalesce(tag(SDK_TAG), F.lit(DEFAULT_SDK))


def ec2() -> Column:
    fields = [tag(t).alias(f) for f, t in EC2_TAGS.items()]
    any_set = reduce(Column.__or__, [tag(t).isNotNull() for t in EC2_TAGS.values()])
    return F.when(any_set, F.struct(*fields))


def aws() -> Column:
    return F.struct(
        F.struct(sdk().alias("sdk")).alias("xray"),
        *[tag(t).alias(f) for f, t in AWS_TAGS.items()],
        ec2().alias("ec2"),
    )


def origin() -> Column:
    return tag(ORIGIN_TAG)


def has_broken_exceptions() -> Column:
    """Whether the exceptions tag holds broken JSON and so is left out.  Reads prepared spans."""
    return tag(CAUSE_TAGS["exceptions"]).isNotNull() & F.col("_exceptions").isNull()


def cause() -> Column:
    """Exceptions become part of the document as the JSON they hold.  Reads prepared spans."""
    return F.when(
        F.col("_has_cause"),
        F.struct(
            tag(CAUSE_TAGS["working_directory"]).alias("working_directory"),
            F.col("_exceptions").alias("exceptions"),
        ),
    )


def tag_annotations() -> Column:
    """Short tags that fill no other field, with underscores for dots.  Reads prepared spans."""
    return F.col("_short")


def metadata() -> Column:
    """Long tags that fill no other field; null when there is none.  Reads prepared spans."""
    return F.when(F.size("_long") > 0, F.col("_long"))


def operation() -> Column:
    """The span name when it is not the request method already and other annotations exist.

    Reads prepared spans.
    """
    return F.when(
        (F.size("_short") > 0) & F.col("_method").isNotNull() & (F.col("_method") != F.col("name")),
        F.col("name"),
    )


def annotations() -> Column:
    """All annotations of the segment; null when there is none.  Reads prepared spans."""
    # a tag called "operation" comes after the generated one and so replaces it
    return F.when(
        F.size("_short") > 0,
        F.when(operation().isNull(), F.col("_short")).otherwise(
            F.map_concat(F.create_map(F.lit("operation"), operation()), F.col("_short"))
        ),
    )


def document() -> Column:
    """The segment as JSON text; absent fields are left out.  Reads prepared spans."""
    return F.to_json(
        F.struct(
            trace_id().alias("trace_id"),
            F.col("parent_id"),
            F.col("id"),
            segment_type().alias("type"),
            namespace().alias("namespace"),
            name().alias("name"),
            start_time().alias("start_time"),
            end_time().alias("end_time"),
            in_progress().alias("in_progress"),
            http().alias("http"),
            status_flag("throttle").alias("throttle"),
            status_flag("fault").alias("fault"),
            status_flag("error").alias("error"),
            sql().alias("sql"),
            aws().alias("aws"),
            origin().alias("origin"),
            cause().alias("cause"),
            annotations().alias("annotations"),
            metadata().alias("metadata"),
        )
    )


def datagram(document_text: Column) -> Column:
    """Header line plus document, as the daemon reads it."""
    return F.concat(F.lit(DATAGRAM_HEADER + "\n"), document_text)
