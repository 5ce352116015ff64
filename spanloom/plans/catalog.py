"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom import session
from spanloom.functions import calls as call_fields
from spanloom.functions import headers, hosts, ids, payload, sampling
from spanloom.functions import segment as seg
from spanloom.operators import (
    budget, calls, dedup, filling, ingest, links, metrics, packing, postings, publish, segments, store,
)
from spanloom.plans import inputs
from spanloom.plans.dialect import SPARK
from spanloom.sources import readers, sinks
from spanloom.streaming import ingest as stream_jobs
from spanloom.streaming import pairing, retry, state, stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The store questions look at everything the tables hold: a window of 40 years up to 2010.
END_TS = 1_262_304_000_000
LOOKBACK = 40 * 365 * 86_400_000
SAMPLE_RATE = 0.25
SAMPLED_TRACES, SAMPLED_SECONDS = 8, 30 * 86_400
# small messages, so that packing has work to do at every scale
QUEUE_BYTES, STREAM_BYTES = 16 * 1024, 32 * 1024
FILLED_BUCKET_BYTES = 256 * 1024


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        session.prepare(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def _flat(spans: DataFrame, *tags: str) -> DataFrame:
    """Scalar span columns plus some tags, for comparing with SQL."""
    return spans.select(
        "trace_id", "parent_id", "id", "kind", "name", "timestamp", "duration",
        "local_service", "remote_service",
        *[F.col("tags")[t].alias(t.replace(".", "_")) for t in tags],
    )


# ---------------------------------------------------------------- sources and sinks


@query
def read_queue_messages(spark, sf_dir):
    path = session.new_run_dir(spark, "queue")
    sinks.write_queue_messages(inputs.queue_messages(spark, sf_dir), path, "json")
    return readers.read_queue_messages(spark, path, "json").select(
        "message_id", "receipt_handle", "transport", "body"
    )


@query
def read_stream_records(spark, sf_dir):
    path = session.new_run_dir(spark, "records")
    sinks.write_stream_records(inputs.stream_records(spark, sf_dir), path)
    return readers.read_stream_records(spark, path).select(
        "message_id", "partition_key", F.lower(F.hex("data")).alias("data_hex"),
        F.octet_length("data").cast("bigint").alias("bytes"),
    )


def _decoded(spans: DataFrame) -> DataFrame:
    return spans.select(
        "transport", "message_id", "trace_id", "id", "name", "timestamp", "duration",
        F.col("tags")["k"].alias("tag_k"),
    )


def _routed(spark, sf_dir) -> DataFrame:
    return ingest.ingest_messages(inputs.queue_messages(spark, sf_dir))


def _routed_records(spark, sf_dir) -> DataFrame:
    return ingest.ingest_records(inputs.stream_records(spark, sf_dir))


@query
def decode_spans_json_v2(spark, sf_dir):
    return _decoded(ingest.decode_spans_v2(_routed(spark, sf_dir)))


@query
def decode_spans_json_v1(spark, sf_dir):
    spans = ingest.decode_spans_v1(ingest.ingest_messages(inputs.v1_messages(spark, sf_dir)))
    return spans.select(
        "message_id", "trace_id", "id", "kind", "name", "timestamp", "duration",
        "local_service", "local_ipv4", "remote_service", "shared",
        F.size("annotations").cast("bigint").alias("annotation_count"),
        F.col("tags")["k"].alias("tag_k"),
        F.size("tags").cast("bigint").alias("tag_count"),
    )


@query
def read_all_spans(spark, sf_dir):
    return _decoded(
        readers.read_all_spans(_routed(spark, sf_dir), _routed_records(spark, sf_dir))
    )


def _reported(spark, sf_dir) -> DataFrame:
    """Encoded spans, with differing reports of some; some carry a long tag, so that every way of travelling occurs."""
    key = packing.partition_key(F.col("local_service"), F.col("trace_id"))
    long_tag = F.expr(f"map('{inputs.LONG_TAG}', {inputs.long_tag_text()})")
    tags = F.map_concat("tags", F.map_filter(long_tag, lambda _, v: v.isNotNull()))
    return packing.encode_spans(inputs.spans(spark, sf_dir).withColumn("tags", tags), key)


def _encoded(spark, sf_dir) -> DataFrame:
    """Of differing reports the first one as text, staged: filling reads sizes first and the whole rows afterwards."""
    path = session.new_run_dir(spark, "encoded")
    unique = dedup.keep_first(_reported(spark, sf_dir), dedup.SPAN_KEY, [F.col("json")])
    with session.dropping_shuffles(spark):
        unique.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def _packed(spark, sf_dir, max_bytes: int, base64: bool) -> DataFrame:
    """The keys are market segments, a handful at any scale."""
    return packing.pack_spans(_reported(spark, sf_dir), max_bytes, base64, first_by=[F.col("json")], few_keys=True)


@query
def write_queue_messages(spark, sf_dir):
    path = session.new_run_dir(spark, "out-queue")
    sinks.write_queue_messages(
        packing.queue_messages(_packed(spark, sf_dir, QUEUE_BYTES, True)), path
    )
    return spark.read.parquet(path).select(
        "pack_key", "batch", "span_count", "list_bytes", F.md5("body").alias("body_md5")
    )


@query
def write_oversize_spans(spark, sf_dir):
    """What no queue message holds, read back from quarantine."""
    path = session.new_run_dir(spark, "oversize")
    sinks.write_oversize(packing.oversize_spans(_packed(spark, sf_dir, QUEUE_BYTES, True)), path)
    return spark.read.parquet(path).select(
        "pack_key", "trace_id", "id", "kind", "size", F.md5("json").alias("json_md5")
    )


@query
def write_stream_records(spark, sf_dir):
    path = session.new_run_dir(spark, "out-records")
    sinks.write_stream_records(
        packing.stream_records(_packed(spark, sf_dir, STREAM_BYTES, False)), path
    )
    return spark.read.parquet(path).select(
        "partition_key", "batch", "span_count", "list_bytes", F.md5("data").alias("data_md5")
    )


def _document_fields(documents: DataFrame, text: str) -> DataFrame:
    """Fields read back from document text."""
    fields = {
        "trace_id": "string", "parent_id": "string", "id": "string", "type": "string",
        "namespace": "string", "name": "string", "start_time": "double", "end_time": "double",
        "in_progress": "boolean", "throttle": "boolean", "fault": "boolean", "error": "boolean",
        "origin": "string",
    }
    doc = F.from_json(
        F.col(text),
        ", ".join(f"{n} {t}" for n, t in fields.items())
        + ", http struct<request:struct<method:string,url:string>,response:struct<status:int>>"
        + ", sql map<string,string>, annotations map<string,string>, metadata map<string,string>"
        + ", aws struct<xray:struct<sdk:string>,operation:string,region:string,table_name:string,"
        + "ec2:struct<instance_id:string>>"
        + ", cause struct<working_directory:string,exceptions:array<struct<id:string,message:string>>>",
    )
    return documents.select(doc.alias("d")).select(
        *[F.col(f"d.{n}").alias(n) for n in fields],
        F.col("d.http.request.method").alias("http_method"),
        F.col("d.http.request.url").alias("http_url"),
        F.col("d.http.response.status").alias("http_status"),
        F.col("d.sql").isNotNull().alias("has_sql"),
        F.col("d.sql")["sanitized_query"].alias("sql_query"),
        F.col("d.aws.xray.sdk").alias("sdk"),
        F.col("d.aws.operation").alias("aws_operation"),
        F.col("d.aws.region").alias("aws_region"),
        F.col("d.aws.table_name").alias("aws_table_name"),
        F.col("d.aws.ec2.instance_id").alias("instance_id"),
        F.col("d.cause.working_directory").alias("working_directory"),
        F.get(F.col("d.cause.exceptions"), 0)["message"].alias("first_exception"),
        F.coalesce(F.size("d.annotations"), F.lit(0)).cast("bigint").alias("annotation_count"),
        F.coalesce(F.size("d.metadata"), F.lit(0)).cast("bigint").alias("metadata_count"),
        F.col("d.annotations")["operation"].alias("operation"),
    )


@query
def xray_document(spark, sf_dir):
    return _document_fields(segments.segment_documents(inputs.spans(spark, sf_dir)), "document")


@query
def write_xray_segments(spark, sf_dir):
    path = session.new_run_dir(spark, "segments")
    sinks.write_segments(segments.segment_documents(inputs.spans(spark, sf_dir)), path)
    lines = spark.read.text(path)
    return _document_fields(lines.filter(F.col("value") != seg.DATAGRAM_HEADER), "value")


@query
def report_xray(spark, sf_dir):
    reported = segments.report(inputs.spans(spark, sf_dir))
    return reported.select(
        "trace_id", "id", F.coalesce("reason", F.lit("sent")).alias("outcome"),
        F.get_json_object("document", "$.aws.xray.sdk").alias("sdk"),
    )


# ---------------------------------------------------------------- filters and routing


@query
def skip_empty_bodies(spark, sf_dir):
    return ingest.skip_empty_bodies(inputs.queue_messages(spark, sf_dir)).select("message_id", "body")


@query
def decode_transport(spark, sf_dir):
    unwrapped = ingest.unwrap(inputs.queue_messages(spark, sf_dir))
    return unwrapped.select(
        "message_id", F.octet_length("payload").cast("bigint").alias("bytes"),
        F.md5("payload").alias("payload_md5"),
    )


@query
def detect_payload_format(spark, sf_dir):
    unwrapped = ingest.unwrap_records(inputs.stream_records(spark, sf_dir))
    return unwrapped.select("message_id", "format")


@query
def route_messages(spark, sf_dir):
    storage_error = F.when(F.col("message_id").cast("bigint") % 48 == 0, F.lit("storage_down")).when(
        F.col("message_id").cast("bigint") % 40 == 0, F.lit("illegal_argument")
    )
    routed = ingest.ingest_messages(inputs.queue_messages(spark, sf_dir), storage_error)
    return routed.select("message_id", "outcome", "counted", "delete")


@query
def require_128bit_trace_id(spark, sf_dir):
    return segments.require_128bit_trace_id(inputs.spans(spark, sf_dir)).select("trace_id", "id")


@query
def sample_traces(spark, sf_dir):
    spans = inputs.spans(spark, sf_dir).withColumn(
        "debug", F.when(F.col("id").startswith("0007"), F.lit(True))
    )
    return ingest.sample_traces(spans, SAMPLE_RATE).select("trace_id", "id", "debug")


@query
def encode_body(spark, sf_dir):
    """Event lists and, being rich in accents, whole document texts as message bodies."""
    texts = inputs.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("key"), F.col("text")
    )
    events = inputs.table(spark, sf_dir, "events").select(
        F.expr("'e' || event_id").alias("key"), F.expr(inputs.list_text(SPARK)).alias("text")
    )
    return texts.unionByName(events).select("key", F.md5(payload.encode_body(F.col("text"))).alias("body_md5"))


@query
def default_sdk_tag(spark, sf_dir):
    tagged = segments.default_sdk_tag(inputs.spans(spark, sf_dir))
    return tagged.select(
        "trace_id", "id", F.col("tags")[seg.SDK_TAG].alias("sdk"),
        F.size("tags").cast("bigint").alias("tag_count"),
    )


@query
def strip_trace_headers(spark, sf_dir):
    cleared = publish.strip_trace_headers(inputs.publishes(spark, sf_dir))
    return cleared.select(
        "batch_id", "entry_id", F.col("attributes")["tenant"].alias("tenant"),
        F.col("attributes")[headers.HEADER_NAME].alias("header"),
        F.size("attributes").cast("bigint").alias("attribute_count"),
    )


@query
def keep_real_errors(spark, sf_dir):
    kept = call_fields.keep_real_error(
        F.col("error"), F.col("has_cause"), F.col("is_service_error"), F.col("error_message")
    )
    return inputs.attempts(spark, sf_dir).select("call_id", "attempt_no", kept.alias("error"))


@query
def empty_to_null(spark, sf_dir):
    return inputs.requests(spark, sf_dir).select(
        "part_key", payload.empty_to_null(F.col("setting")).alias("setting")
    )


# ---------------------------------------------------------------- segment projection


def _segment_query(name: str, columns: Callable[[], dict[str, Column]]) -> None:
    """Register a projection; its columns are built when it runs, as they need a session."""

    def run(spark, sf_dir):
        return seg.prepared(inputs.spans(spark, sf_dir)).select(
            "trace_id", "id", *[c.alias(n) for n, c in columns().items()]
        )

    run.__name__ = name
    query(run)


_segment_query("xray_trace_id", lambda: {
    "xray_trace_id": F.when(F.length("trace_id") == seg.TRACE_ID_LENGTH, seg.trace_id()),
})
_segment_query("xray_parent_id", lambda: {"parent_id": F.col("parent_id")})
_segment_query("xray_type", lambda: {"type": seg.segment_type()})
_segment_query("xray_namespace", lambda: {"namespace": seg.namespace()})
_segment_query("xray_name", lambda: {"name": seg.name()})
_segment_query("xray_times", lambda: {
    "start_time": seg.start_time(), "end_time": seg.end_time(), "in_progress": seg.in_progress(),
})
_segment_query("xray_http", lambda: {
    "has_http": seg.http().isNotNull(),
    "http_method": seg.http()["request"]["method"],
    "http_url": seg.http()["request"]["url"],
    "http_status": seg.http()["response"]["status"],
})
_segment_query("xray_status_class", lambda: {"status_class": seg.status_class()})
_segment_query("xray_sql", lambda: {
    "has_sql": seg.sql().isNotNull(), **{f"sql_{f}": seg.sql()[f] for f in seg.SQL_TAGS},
})
_segment_query("xray_aws", lambda: {
    "sdk": seg.aws()["xray"]["sdk"], **{f: seg.aws()[f] for f in seg.AWS_TAGS},
})
_segment_query("xray_ec2", lambda: {
    "has_ec2": seg.ec2().isNotNull(), "instance_id": seg.ec2()["instance_id"],
})
_segment_query("xray_origin", lambda: {"origin": seg.origin()})
_segment_query("xray_cause", lambda: {
    "has_cause": seg.cause().isNotNull(),
    "working_directory": seg.cause()["working_directory"],
    "first_exception": F.try_variant_get(seg.cause()["exceptions"], "$[0].message", "string"),
    "broken": F.coalesce(seg.has_broken_exceptions(), F.lit(False)),
})
_segment_query("xray_operation", lambda: {"operation": seg.operation()})


@query
def xray_annotations(spark, sf_dir):
    return segments.segment_entries(inputs.spans(spark, sf_dir), seg.tag_annotations())


@query
def xray_metadata(spark, sf_dir):
    return segments.segment_entries(inputs.spans(spark, sf_dir), seg.metadata())


@query
def xray_segments(spark, sf_dir):
    """All scalar segment fields of all encodable spans at once: the flagship."""
    segment_rows = segments.segment_columns(inputs.spans(spark, sf_dir))
    return segment_rows.drop("annotations", "metadata")


# ---------------------------------------------------------------- trace headers


def _parsed_headers(spark, sf_dir) -> DataFrame:
    return inputs.request_headers(spark, sf_dir).withColumn(
        "parsed", headers.parse_trace_header(F.col("header"))
    )


def _context_columns() -> list[Column]:
    return [
        F.col("parsed.root").alias("root"), F.col("parsed.parent").alias("parent"),
        F.col("parsed.sampled").alias("sampled"), F.col("parsed.custom").alias("custom"),
    ]


@query
def parse_trace_header(spark, sf_dir):
    return _parsed_headers(spark, sf_dir).select("request_key", *_context_columns())


@query
def classify_trace_context(spark, sf_dir):
    return _parsed_headers(spark, sf_dir).select(
        "request_key", headers.classify_trace_context(F.col("parsed")).alias("context")
    )


@query
def format_trace_header(spark, sf_dir):
    spans = segments.require_128bit_trace_id(inputs.spans(spark, sf_dir))
    sampled = F.when(F.col("duration").isNotNull(), F.col("duration") % 2 == 0)
    custom = F.when(F.col("kind").isNull(), F.lit(";Tenant=north-7"))
    header = headers.format_trace_header(F.col("trace_id"), F.col("id"), sampled, custom)
    return spans.select("trace_id", "id", header.alias("header"))


@query
def format_root_id(spark, sf_dir):
    spans = segments.require_128bit_trace_id(inputs.spans(spark, sf_dir))
    return spans.select("id", headers.format_root_id(F.col("trace_id")).alias("root"))


@query
def root_from_passthrough(spark, sf_dir):
    return inputs.request_headers(spark, sf_dir).select(
        "request_key", headers.root_from_passthrough(F.col("header")).alias("root")
    )


@query
def root_epoch(spark, sf_dir):
    spans = segments.require_128bit_trace_id(inputs.spans(spark, sf_dir))
    epoch = F.unix_seconds(headers.root_epoch(F.col("trace_id")))
    return spans.select("trace_id", epoch.alias("epoch_seconds"))


@query
def hex_id(spark, sf_dir):
    events = inputs.table(spark, sf_dir, "events")
    return events.select("event_id", ids.hex_id(F.col("event_id") * 1_000_003).alias("hex"))


@query
def parse_lambda_header(spark, sf_dir):
    """The header as an environment value; an absent value gives an empty context."""
    value = F.when(F.col("request_key") % 3 != 0, F.col("header"))
    parsed = inputs.request_headers(spark, sf_dir).withColumn(
        "parsed", headers.parse_trace_header(value)
    )
    return parsed.select(
        "request_key", *_context_columns(),
        headers.classify_trace_context(F.col("parsed")).alias("context"),
    )


@query
def custom_fields(spark, sf_dir):
    fields = headers.custom_fields(F.col("parsed.custom"))
    return _parsed_headers(spark, sf_dir).select(
        "request_key", fields["Robot"].alias("robot"), fields["CalledFrom"].alias("called_from")
    )


# ---------------------------------------------------------------- spans from logs


_CALL_TAGS = [
    "aws.service_name", "aws.operation", "aws.request_id", "http.status_code", "error",
]


@query
def sdk_call_spans(spark, sf_dir):
    return _flat(calls.sdk_call_spans(inputs.attempts(spark, sf_dir)), *_CALL_TAGS)


def _operation_flat(spans: DataFrame) -> DataFrame:
    return _flat(spans, *_CALL_TAGS).drop("aws_request_id")


@query
def sdk_operation_spans(spark, sf_dir):
    return _operation_flat(calls.sdk_operation_spans(inputs.attempts(spark, sf_dir)))


@query
def call_annotations(spark, sf_dir):
    return calls.call_annotations(inputs.attempts(spark, sf_dir))


@query
def publish_spans(spark, sf_dir):
    return _flat(publish.publish_spans(inputs.publishes(spark, sf_dir)), "queue.url")


@query
def publish_batch_spans(spark, sf_dir):
    return _flat(publish.publish_batch_spans(inputs.publishes(spark, sf_dir)), "queue.url")


@query
def inject_message_headers(spark, sf_dir):
    located = publish.publish_contexts(inputs.publishes(spark, sf_dir), SAMPLE_RATE)
    return publish.inject_message_headers(located).select(
        "batch_id", "entry_id", F.col("attributes")["tenant"].alias("tenant"),
        F.col("attributes")[headers.HEADER_NAME].alias("header"),
    )


@query
def resolve_parent(spark, sf_dir):
    return publish.publish_contexts(inputs.publishes(spark, sf_dir)).select(
        "batch_id", "entry_id", "context.trace_id", "context.parent_id",
        F.col("context.sampled").alias("sampled"), F.col("context.custom").alias("custom"),
    )


@query
def operation_name(spark, sf_dir):
    operation = call_fields.operation_name(F.col("request_class"))
    return inputs.attempts(spark, sf_dir).groupBy(operation.alias("operation")).agg(
        F.count("*").alias("attempts")
    )


@query
def request_url(spark, sf_dir):
    url = call_fields.request_url(F.col("endpoint"), F.col("path"), F.col("parameters"))
    return inputs.requests(spark, sf_dir).select("part_key", url.alias("url"))


@query
def request_id(spark, sf_dir):
    chosen = call_fields.request_id(
        F.col("is_service_error"), F.col("request_id"), F.col("has_result"), F.col("request_id"),
        F.col("header_request_id"),
    )
    return inputs.attempts(spark, sf_dir).select("call_id", "attempt_no", chosen.alias("request_id"))


@query
def deferred_root_sampling(spark, sf_dir):
    log = inputs.attempts(spark, sf_dir)
    inherited = F.when(F.col("trace_id").isNotNull(), F.lit(True)).alias("inherited")
    one_per_call = calls.with_call_context(log.withColumn("inherited", inherited)).select(
        "call_id", "trace_id", "request_rule", "inherited"
    ).distinct()
    decision = sampling.deferred_root_decision(
        F.col("trace_id"), F.col("request_rule"), SAMPLE_RATE, F.col("inherited")
    )
    return one_per_call.select("call_id", decision.alias("sampled"))


@query
def header_first_value(spark, sf_dir):
    first = call_fields.header_first_value(F.col("headers"), "x-request")
    absent = call_fields.header_first_value(F.col("headers"), "x-other")
    return inputs.requests(spark, sf_dir).select(
        "part_key", first.alias("first"), absent.alias("absent")
    )


@query
def response_status(spark, sf_dir):
    return inputs.requests(spark, sf_dir).select(
        "part_key", call_fields.response_status(F.col("status")).alias("status")
    )


# ---------------------------------------------------------------- counters and packing


@query
def collector_metrics(spark, sf_dir):
    return metrics.collector_metrics(_routed(spark, sf_dir))


@query
def message_size(spark, sf_dir):
    sized = ingest.unwrap(inputs.queue_messages(spark, sf_dir)).withColumn(
        "list_bytes", F.octet_length("payload").cast("bigint")
    )
    return metrics.message_size(sized, ["transport"], "list_bytes")


@query
def pack_spans(spark, sf_dir):
    return _packed(spark, sf_dir, QUEUE_BYTES, True).select(
        "pack_key", "trace_id", "id", "kind", "size", "packing", "batch"
    )


@query
def fill_messages(spark, sf_dir):
    """Packing by size classes; small buckets, so that keys have several at every scale."""
    filled = filling.fill_messages(_encoded(spark, sf_dir), QUEUE_BYTES, True, FILLED_BUCKET_BYTES)
    return filled.select("pack_key", "trace_id", "id", "kind", "size", "packing", "batch")


@query
def partition_key(spark, sf_dir):
    host = F.when(F.col("event_id") % 4 != 0, F.concat(F.lit("host-"), F.col("user_id").cast("string")))
    key = packing.partition_key(host, F.concat(F.lit("producer-"), F.col("user_id").cast("string")))
    return inputs.table(spark, sf_dir, "events").select("event_id", key.alias("partition_key"))


# ---------------------------------------------------------------- trace store


def _written_store(spark, sf_dir) -> str:
    path = session.new_run_dir(spark, "store")
    store.write_unique_spans(inputs.delivered_spans(spark, sf_dir), path, "year")
    return path


def _store(spark, sf_dir) -> DataFrame:
    """The trace store: delivered spans, without duplicates, as a table of a folder a year."""
    return store.read_spans(spark, _written_store(spark, sf_dir), "year")


@query
def get_traces(spark, sf_dir):
    found = store.get_traces(
        _store(spark, sf_dir), end_ts=END_TS, lookback=LOOKBACK, service="building",
        tags={"http.path": None}, min_duration=1_000_000, limit=10,
    )
    return _flat(found)


@query
def get_traces_indexed(spark, sf_dir):
    """The same question, and answer, by an index of services, names and tags."""
    path, index = _written_store(spark, sf_dir), session.new_run_dir(spark, "index")
    postings.build(spark, path, index, "year")
    found = postings.get_traces(
        spark, path, index, period="year", end_ts=END_TS, lookback=LOOKBACK, service="building",
        tags={"http.path": None}, min_duration=1_000_000, limit=10,
    )
    return _flat(found)


@query
def sample_to_budget(spark, sf_dir):
    """Eight traces per service and month-long stretch of time, with their weights."""
    return budget.sample_traces(_store(spark, sf_dir), SAMPLED_TRACES, SAMPLED_SECONDS)


@query
def get_trace(spark, sf_dir):
    stored = _store(spark, sf_dir)
    latest = stored.agg(F.max("trace_id")).first()[0]
    return _flat(store.get_trace(stored, latest))


@query
def get_service_names(spark, sf_dir):
    return store.get_service_names(_store(spark, sf_dir))


@query
def get_span_names(spark, sf_dir):
    return store.get_span_names(_store(spark, sf_dir), "building")


@query
def get_dependencies(spark, sf_dir):
    return store.get_dependencies(_store(spark, sf_dir), END_TS, LOOKBACK)


@query
def service_links(spark, sf_dir):
    """Links to the nearest ancestor of another service."""
    return links.service_links(_store(spark, sf_dir), END_TS, LOOKBACK)


@query
def correlate_logs(spark, sf_dir):
    joined = store.correlate_logs(inputs.request_logs(spark, sf_dir), _store(spark, sf_dir))
    return joined.select("request_id", "trace_id", "state", "span_count", "first_ts")


@query
def correlate_logs_indexed(spark, sf_dir):
    """The same from the index of the store, without reading a span."""
    path, index = _written_store(spark, sf_dir), session.new_run_dir(spark, "index")
    postings.build(spark, path, index, "year")
    joined = postings.correlate_logs(spark, inputs.request_logs(spark, sf_dir), path, index, period="year")
    return joined.select("request_id", "trace_id", "state", "span_count", "first_ts")


@query
def untraced_requests(spark, sf_dir):
    return store.untraced_requests(
        inputs.request_logs(spark, sf_dir), _store(spark, sf_dir)
    ).select("request_id", "state")


# ---------------------------------------------------------------- regions


@query
def region_from_hosts(spark, sf_dir):
    answer = hosts.region_from_hosts(F.col("hosts"))
    return inputs.host_lists(spark, sf_dir).select(
        "host_key", answer["region"].alias("region"), answer["status"].alias("status")
    )


# ---------------------------------------------------------------- streaming


def _events_stream(spark, sf_dir) -> DataFrame:
    return inputs.stream_table(spark, sf_dir, "events")


@query
def stream_ingest(spark, sf_dir):
    run = session.new_run_dir(spark, "ingest")
    messages = inputs.messages(_events_stream(spark, sf_dir))
    stream_jobs.stream_ingest(messages, f"{run}/out", f"{run}/checkpoint", True).awaitTermination()
    return _decoded(stream_jobs.stored_spans(spark, f"{run}/out"))


@query
def acknowledgements(spark, sf_dir):
    """Which messages a stored stream lets the queue delete."""
    run = session.new_run_dir(spark, "acknowledge")
    messages = inputs.messages(_events_stream(spark, sf_dir))
    stream_jobs.stream_ingest(messages, f"{run}/out", f"{run}/checkpoint", True).awaitTermination()
    return stream_jobs.acknowledgements(spark, f"{run}/out")


@query
def stream_ingest_records(spark, sf_dir):
    run = session.new_run_dir(spark, "ingest-records")
    records = inputs.records(_events_stream(spark, sf_dir))
    stream_jobs.stream_ingest_records(
        records, f"{run}/out", f"{run}/checkpoint", True
    ).awaitTermination()
    outcomes = stream_jobs.stored_outcomes(spark, f"{run}/out")
    return outcomes.groupBy("outcome").agg(
        F.count("*").alias("records"), F.sum(F.col("bytes").cast("bigint")).alias("bytes"),
        F.coalesce(F.sum(F.col("spans").cast("bigint")), F.lit(0)).alias("spans"),
    )


@query
def dedup_spans(spark, sf_dir):
    return _flat(dedup.dedup_spans(inputs.delivered_spans(spark, sf_dir)))


@query
def dedup_spans_stream(spark, sf_dir):
    """Every message delivered twice, in several micro-batches; the stream keeps one copy of each span."""
    run = session.new_run_dir(spark, "dedup")
    messages = inputs.queue_messages(spark, sf_dir)
    for delivery in range(2):
        sinks.write_queue_messages(messages.repartition(3, "message_id"), f"{run}/in/{delivery}")
    arriving = readers.stream_queue_messages(spark, f"{run}/in/*", max_batch=2)
    unique = state.dedup_stream(ingest.decode_spans(ingest.ingest_messages(arriving)), "60 days")
    state.append_to(unique, f"{run}/out", f"{run}/checkpoint", True).awaitTermination()
    return _decoded(spark.read.parquet(f"{run}/out"))


@query
def metrics_by_window(spark, sf_dir):
    return metrics.metrics_by_window(_routed(spark, sf_dir))


@query
def metrics_by_sliding_window(spark, sf_dir):
    return metrics.metrics_by_window(_routed(spark, sf_dir), length="1 hour", slide="20 minutes")


@query
def metrics_by_window_stream(spark, sf_dir):
    """The windows as the stream has stored them so far, open ones included."""
    run = session.new_run_dir(spark, "metrics")
    routed = ingest.ingest_messages(inputs.messages(_events_stream(spark, sf_dir)))
    windows = state.metrics_stream(routed)
    state.upsert_to(windows, f"{run}/out", f"{run}/checkpoint", True).awaitTermination()
    return state.newest(spark, f"{run}/out")


@query
def pair_call_events(spark, sf_dir):
    """Events of the whole call log."""
    events = calls.call_events(inputs.attempts(spark, sf_dir))
    return _operation_flat(state.pair_call_events(events))


@query
def pair_call_events_stream(spark, sf_dir):
    """The same from a stream of events, whatever micro-batch brings them."""
    run = session.new_run_dir(spark, "pairing")
    events = calls.call_events(inputs.stream_attempts(spark, sf_dir))
    state.stream_call_parts(events, f"{run}/out", f"{run}/checkpoint", True).awaitTermination()
    return _operation_flat(state.stored_calls(spark, f"{run}/out"))


@query
def pair_call_events_timed(spark, sf_dir):
    """The same with keyed state and timers, over micro-batches of neighbouring times.

    A last event far in the future lets all timers go off; its own call is left out.
    """
    run = session.new_run_dir(spark, "timed-pairing")
    events = calls.call_events(inputs.attempts(spark, sf_dir))
    # of the events as they were staged, so that the log is read and sampled once for both
    kept = spark.read.schema(events.schema).parquet
    for part in range(2):
        staged = events.repartitionByRange(4, "event.timestamp") if part == 0 else (
            kept(f"{run}/in/part=0").orderBy("event.timestamp").limit(1).withColumns({
                "call_id": F.lit(_LAST_CALL),
                "event": F.col("event").withField("timestamp", F.lit(END_TS * 1000).cast("bigint")),
            })
        )
        with session.dropping_shuffles(spark):
            staged.write.parquet(f"{run}/in/part={part}")
        arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{run}/in/*")
        pairing.stream_calls(arriving, f"{run}/out", f"{run}/checkpoint", True).awaitTermination()
    merged = calls.merge_parts(pairing.paired(spark, f"{run}/out"))
    return _operation_flat(calls.part_spans(merged.filter(F.col("call_id") != _LAST_CALL)))


_LAST_CALL = "last"


def _deliveries(spark, sf_dir, run: str, times: int, files: int) -> DataFrame:
    """All messages some times over, as a stream of as many micro-batches as there are files."""
    messages = inputs.queue_messages(spark, sf_dir)
    for delivery in range(times):
        sinks.write_queue_messages(messages.repartition(files, "message_id"), f"{run}/in/{delivery}")
    return readers.stream_queue_messages(spark, f"{run}/in/*", max_batch=1)


@query
def stream_store(spark, sf_dir):
    """Six micro-batches stored, merged on the way, read as of the latest snapshot."""
    run = session.new_run_dir(spark, "stream-store")
    routed = ingest.ingest_messages(_deliveries(spark, sf_dir, run, 1, 6))
    sink = stored.compacting_sink(f"{run}/out", period="year", fan_in=2)
    stream_jobs.run(routed, sink, f"{run}/checkpoint", True).awaitTermination()
    return _decoded(stored.read_spans(spark, f"{run}/out", "year"))


@query
def dedup_spans_store(spark, sf_dir):
    """Every message delivered twice; the store takes no span a second time, however late it comes."""
    run = session.new_run_dir(spark, "dedup-store")
    routed = ingest.ingest_messages(_deliveries(spark, sf_dir, run, 2, 3))
    sink = stored.compacting_sink(f"{run}/out", period="year", fan_in=2, unique=True)
    stream_jobs.run(routed, sink, f"{run}/checkpoint", True).awaitTermination()
    return _decoded(stored.read_spans(spark, f"{run}/out", "year"))


@query
def retry_messages(spark, sf_dir):
    """Seven micro-batches, of which two fail; what they held is stored by later ones."""
    run = session.new_run_dir(spark, "retry")
    routed = ingest.ingest_messages(_deliveries(spark, sf_dir, run, 1, 7))
    inner = stored.compacting_sink(f"{run}/out", period="year", fan_in=2)

    def failing(batch: DataFrame, batch_id: int) -> None:
        if batch_id in (1, 2):
            raise OSError("out of reach")
        inner(batch, batch_id)

    # a minute passes from one micro-batch to the next
    minutes = iter(range(0, 60 * 100, 60))
    sink = retry.retrying_sink(
        failing, f"{run}/retry", retry.Schedule(first_delay=30), retry.forget_batch(f"{run}/out"),
        lambda: next(minutes),
    )
    stream_jobs.run(routed, sink, f"{run}/checkpoint", True).awaitTermination()
    return _decoded(stored.read_spans(spark, f"{run}/out", "year"))


@query
def max_batch(spark, sf_dir):
    """Messages in twelve files, at most three files a micro-batch."""
    run = session.new_run_dir(spark, "max-batch")
    staged = inputs.queue_messages(spark, sf_dir).repartition(12, "message_id")
    sinks.write_queue_messages(staged, f"{run}/in")
    arriving = readers.stream_queue_messages(spark, f"{run}/in", max_batch=3)
    stream_jobs.stream_ingest(arriving, f"{run}/out", f"{run}/checkpoint", True).awaitTermination()
    outcomes = stream_jobs.stored_outcomes(spark, f"{run}/out")
    return outcomes.agg(
        F.countDistinct("batch").alias("batches"), F.count("*").alias("messages"),
        F.count_if(F.col("outcome") == ingest.ACCEPTED).alias("accepted"),
    )


def queries() -> dict[str, Query]:
    return dict(QUERIES)
