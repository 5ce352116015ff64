import pytest
from pyspark.sql import functions as F

from spanloom import schema
from spanloom.functions import calls as fields
from spanloom.functions import headers, hosts
from spanloom.operators import calls, publish

LOG = (
    "call_id string, attempt_no bigint, service string, request_class string, trace_id string, "
    "parent_id string, send_ts bigint, recv_ts bigint, status int, request_id string"
)


def log(spark, *rows):
    return spark.createDataFrame(list(rows), LOG)


def attempt(no, send, recv, status, request_id=None, call="c1", trace="t" * 32, parent="p" * 16):
    return (call, no, "StockTableV3", "CountShelvesRequest", trace, parent, send, recv, status, request_id)


def test_one_attempt(spark):
    spans = {r["name"]: r for r in calls.sdk_call_spans(log(spark, attempt(1, 10, 30, 200, "abcd"))).collect()}
    local, client = spans["aws-sdk"], spans["CountShelves"]
    assert client["kind"] == "CLIENT" and client["remote_service"] == "StockTableV3"
    assert client["tags"] == {"aws.request_id": "abcd"} and client["parent_id"] == local["id"]
    assert local["kind"] is None and local["parent_id"] == "p" * 16
    assert local["tags"] == {"aws.service_name": "StockTableV3", "aws.operation": "CountShelves"}
    assert (local["timestamp"], local["duration"]) == (10, 20)


def test_failed_attempt_then_success(spark):
    rows = log(spark, attempt(1, 10, 30, 500), attempt(2, 40, 45, 200))
    local = calls.sdk_call_spans(rows).filter("name = 'aws-sdk'").first()
    assert "error" not in local["tags"] and local["duration"] == 35
    (span,) = calls.sdk_operation_spans(rows).collect()
    notes = calls.call_annotations(rows).orderBy("timestamp").collect()
    assert [(a["value"], a["timestamp"]) for a in notes] == [("ws", 10), ("wr", 30), ("ws", 40), ("wr", 45)]
    assert {(a["trace_id"], a["id"]) for a in notes} == {(span["trace_id"], span["id"])}
    assert "error" not in span["tags"]


def test_failed_call_marks_both_spans(spark):
    spans = calls.sdk_call_spans(log(spark, attempt(1, 10, 30, 503))).collect()
    assert {s["tags"].get("error") for s in spans} == {"503"}


def test_extra_tags_reach_the_client_span(spark):
    spans = calls.sdk_call_spans(
        log(spark, attempt(1, 10, 30, 200)), {"region": F.lit("eu"), "none": F.lit(None).cast("string")})
    assert {s["name"]: s["tags"].get("region") for s in spans.collect()} == {"aws-sdk": None, "CountShelves": "eu"}
    assert not spans.filter("map_contains_key(tags, 'none')").count()


def test_extra_tags_of_the_one_span_model_are_the_last_attempts(spark):
    rows = log(spark, attempt(2, 40, 45, 200, "b"), attempt(1, 10, 30, 500, "a"))
    (span,) = calls.sdk_operation_spans(rows, {"own": F.col("request_id"), "none": F.lit(None).cast("string")}).collect()
    assert span["tags"]["own"] == "b" and "none" not in span["tags"]


def test_only_sampled_calls_are_reported(spark):
    """Inherited decisions come first, then the request rule, then the rate."""
    facts = [("kept", "t" * 32, True, False), ("dropped", "t" * 32, False, True), ("open", "t" * 32, None, False),
             ("ruled", None, None, True), ("ruled out", None, None, False), ("rate", None, None, None)]
    base = log(spark, *[attempt(1, 10, 30, 200, call=c, trace=t, parent="p" * 16) for c, t, _, _ in facts])
    rows = base.join(spark.createDataFrame(
        [(c, s, r) for c, _, s, r in facts], "call_id string, sampled boolean, request_rule boolean"), "call_id")
    for rate, expected in ((1.0, {"kept", "ruled", "rate"}), (0.0, {"kept", "ruled"})):
        assert {r["call_id"] for r in calls.sampled_calls(rows, rate).collect()} == expected
        assert calls.sdk_call_spans(rows, rate=rate).count() == 2 * len(expected)
        assert calls.sdk_operation_spans(rows, rate=rate).count() == len(expected)
        assert calls.call_annotations(rows, rate).count() == 2 * len(expected)


def test_unfinished_call_has_no_duration(spark):
    rows = log(spark, attempt(1, 10, 30, 500), attempt(2, 40, None, None))
    assert calls.sdk_operation_spans(rows).first()["duration"] is None
    assert calls.sdk_call_spans(rows).filter("name = 'aws-sdk'").first()["duration"] is None


def test_new_root_gets_a_repeatable_trace(spark):
    rows = log(spark, attempt(1, 10, 30, 200, trace=None, parent=None))
    first = {r["trace_id"] for r in calls.sdk_call_spans(rows).collect()}
    second = {r["trace_id"] for r in calls.sdk_operation_spans(rows).collect()}
    assert first == second and len(first) == 1 and len(first.pop()) == 32


@pytest.mark.parametrize("n", [2, 10_001])
def test_a_long_call_is_a_span_like_any_other(spark, n):
    busy = spark.range(1, n + 1).selectExpr(
        "'busy' call_id", "id attempt_no", "'s' service", "'GetRequest' request_class", "repeat('t', 32) trace_id",
        "repeat('p', 16) parent_id", "10 * id send_ts", "10 * id + 5 recv_ts", "cast(500 as int) status",
        "cast(null as string) request_id")
    (span,) = calls.sdk_operation_spans(busy).collect()
    assert (span["timestamp"], span["duration"], span["tags"]["error"]) == (10, 10 * n - 5, "500")
    notes = calls.call_annotations(busy).filter((F.col("id") == span["id"]) & (F.col("trace_id") == span["trace_id"]))
    assert {r["value"]: r["count"] for r in notes.groupBy("value").count().collect()} == {"ws": n, "wr": n}
    assert calls.event_spans(calls.call_events(busy)).collect() == [span]


@pytest.mark.parametrize("message, cause, service, kept", [
    ("connection refused", True, False, True), ("repeats the status", False, True, False),
])
def test_reported_errors_are_kept(spark, message, cause, service, kept):
    rows = log(spark, attempt(1, 10, None, None)).select(
        "*", F.lit(message).alias("error"), F.lit(cause).alias("has_cause"),
        F.lit(service).alias("is_service_error"), F.lit(None).cast("string").alias("error_message"))
    assert {s["tags"].get("error") for s in calls.sdk_call_spans(rows).collect()} == {message}
    assert calls.sdk_operation_spans(rows).first()["tags"].get("error") == (message if kept else None)


PUBLISH = (
    "batch_id string, entry_id string, queue_url string, batch_ts bigint, sent_ts bigint, "
    "local_service string, attributes map<string,string>, "
    "scope struct<trace_id:string,span_id:string,sampled:boolean>"
)
HEADER = "Root=1-65f0c2aa-00112233445566778899aabb;Parent=0f1e2d3c4b5a6978;Sampled=0;k=v"


def entry(spark, *rows):
    return spark.createDataFrame(
        [("b1", str(i), "http://q", 1_000_000, 1_000_000 + i, "app", a, s) for i, (a, s) in enumerate(rows)],
        PUBLISH,
    )


def test_batch_of_two_is_three_spans(spark):
    spans = publish.publish_batch_spans(entry(spark, ({}, None), ({"t": "1"}, None))).collect()
    (parent,) = [s for s in spans if s["name"] == "publish-batch"]
    children = [s for s in spans if s["name"] == "publish"]
    assert len(children) == 2 and {c["parent_id"] for c in children} == {parent["id"]}
    assert {s["trace_id"] for s in spans} == {parent["trace_id"]} and parent["parent_id"] is None
    assert {s["kind"] for s in spans} == {"PRODUCER"} and {s["remote_service"] for s in spans} == {"amazon-sqs"}
    assert all(c["tags"] == {"queue.url": "http://q"} and c["duration"] == 0 for c in children)
    older = publish.publish_batch_spans(entry(spark, ({}, None)), legacy=True)
    assert older.filter("name = 'publish-batch'").first()["kind"] is None


def test_single_message_continues_its_header(spark):
    located = publish.publish_contexts(entry(
        spark, ({headers.HEADER_NAME: HEADER, "t": "1"}, None), ({"t": "1"}, None),
        ({headers.HEADER_NAME: HEADER}, ("s" * 32, "9" * 16, True)),
        ({headers.HEADER_NAME: "Sampled=0"}, None),
    ))
    rows = publish.inject_message_headers(located).orderBy("entry_id").collect()
    continued, fresh, scoped, flagged = rows
    assert (continued["context"]["trace_id"], continued["context"]["parent_id"]) == (
        "65f0c2aa00112233445566778899aabb", "0f1e2d3c4b5a6978")
    assert continued["attributes"] == {
        "t": "1",
        headers.HEADER_NAME: HEADER.replace("0f1e2d3c4b5a6978", continued["span_id"]),
    }
    assert fresh["context"]["parent_id"] is None and fresh["attributes"][headers.HEADER_NAME].endswith("Sampled=1")
    assert scoped["context"]["trace_id"] == "s" * 32 and scoped["context"]["parent_id"] == "9" * 16
    assert flagged["context"]["parent_id"] is None and flagged["sampled"] is False


def test_a_header_is_read_once_a_message(spark):
    """Neither the sampling filter nor a field of the context reads it again."""
    spark.conf.set("spark.sql.debug.maxToStringFields", "100000")
    try:
        # behind an exchange, as the optimizer works rows of a list out
        spans = publish.publish_spans(entry(spark, ({headers.HEADER_NAME: HEADER}, None)).repartition(2))
        plan = spans._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert plan.count("aggregate(") == 1


def test_headers_travel_where_they_are_told(spark):
    """Another column, and two names: the first found is read, both are cleared, the first is written."""
    names = ("trace", "old-trace")
    rows = entry(spark, ({"old-trace": HEADER, "t": "1"}, None)).withColumnRenamed("attributes", "meta")
    located = publish.publish_contexts(rows, carrier="meta", names=names)
    (row,) = publish.inject_message_headers(located, "meta", names).collect()
    assert row["context"]["parent_id"] == "0f1e2d3c4b5a6978"
    assert set(row["meta"]) == {"t", "trace"} and row["span_id"] in row["meta"]["trace"]
    assert publish.strip_trace_headers(rows, "meta", names).first()["meta"] == {"t": "1"}


def test_batch_spans_of_a_batch_need_one_shuffle(spark):
    plan = publish.publish_batch_spans(entry(spark, ({}, None)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_call_fields(spark):
    row = spark.range(1).select(
        fields.operation_name(F.lit("ListBucketsRequest")),
        fields.operation_name(F.lit("RequestSpot")),
        fields.request_url(F.lit("http://h"), F.lit("/p"), F.expr("map('a', array('1', '2'), '', array('x'), 'b', array('3'))")),
        fields.request_url(F.lit("http://h"), F.lit(None).cast("string"), F.expr("cast(map() as map<string,array<string>>)")),
        fields.header_first_value(F.expr("map('h', array('a', 'b'))"), "h"),
        fields.header_first_value(F.expr("map('h', cast(array() as array<string>))"), "h"),
        fields.response_status(F.lit(None).cast("int")),
        fields.keep_real_error(F.lit("e"), F.lit(False), F.lit(True), F.lit(None).cast("string")),
        fields.keep_real_error(F.lit("e"), F.lit(False), F.lit(True), F.lit("why")),
        fields.keep_real_error(F.lit("e"), F.lit(True), F.lit(True), F.lit(None).cast("string")),
        fields.keep_real_error(F.lit("e"), F.lit(False), F.lit(False), F.lit(None).cast("string")),
    ).first()
    assert tuple(row) == (
        "ListBuckets", "RequestSpot", "http://h/p?a=1&b=3", "http://h", "a", None, 0, None, "e", "e", "e",
    )


AWS = "https://search-shelves-q7.us-west-2.es.amazonaws.com"
OTHER = "https://plain.example:9200"


@pytest.mark.parametrize("hosts_text, region, status", [
    (AWS, "us-west-2", "ok"), (OTHER, None, "none"), (f"{OTHER},{AWS}", "us-west-2", "ok"),
    (f"{AWS},{OTHER}", None, "mismatched regions"), (f"{AWS},{AWS}", None, "too many regions"),
    (f"{OTHER},{AWS},{AWS},{OTHER}", None, "too many regions"),
    (AWS.upper(), "US-WEST-2", "ok"), ("http" + AWS[5:], None, "none"),
])
def test_region(spark, hosts_text, region, status):
    answer = hosts.region_from_hosts(F.lit(hosts_text))
    assert tuple(spark.range(1).select(answer["region"], answer["status"]).first()) == (region, status)


def test_log_columns_cover_the_span_schema(spark):
    spans = calls.sdk_operation_spans(log(spark, attempt(1, 10, 30, 200)))
    assert spans.columns == list(schema.SPAN_FIELDS)


def test_a_conflict_far_down_the_host_list_is_found(spark):
    plain = ",".join(f"host{i}" for i in range(150))
    other = AWS.replace("us-west-2", "eu-west-1")
    df = spark.createDataFrame([(f"{plain},{AWS},{other}",), (f"{plain},{AWS}",)], "h string")
    found = [r.s for r in df.select(hosts.region_from_hosts(F.col("h"))["status"].alias("s")).collect()]
    assert found == ["too many regions", "ok"]
