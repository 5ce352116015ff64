import base64
import json

import pytest
from pyspark.sql import functions as F

from spanloom import schema
from spanloom.functions import payload
from spanloom.operators import ingest, metrics
from spanloom.plans import inputs

SPAN = {"traceId": "00000000000000AB", "id": "b", "name": "get"}


def messages(spark, *bodies):
    rows = [(str(i), f"r{i}", "sqs", b, None) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, schema.QUEUE_MESSAGE)


def outcomes(spark, *bodies):
    routed = ingest.ingest_messages(messages(spark, *bodies))
    return [r["outcome"] for r in routed.orderBy(F.col("message_id").cast("int")).collect()]


def listed(*spans):
    return json.dumps(list(spans))


BODIES = [
    ("", "skipped"), ("[]", "skipped"), (None, "skipped"),
    (listed(SPAN), "accepted"),
    (base64.b64encode(listed(SPAN).encode()).decode(), "accepted"),
    (base64.b64encode(listed({**SPAN, "name": "💩"}).encode()).decode().rstrip("="), "accepted"),
    ("[ ]", "accepted"),
    ("[three spans, none of them JSON]", "malformed"),
    (listed(SPAN, {"traceId": "zz"}), "malformed"),
    (listed(SPAN, {"traceId": "1"}), "malformed"),
    (listed({**SPAN, "timestamp": "soon"}), "malformed"),
    (listed({**SPAN, "kind": "UNHEARD"}), "malformed"),
    (listed({**SPAN, "traceId": "1" * 33}), "malformed"),
    (listed({**SPAN, "parentId": "xyz"}), "malformed"),
    (listed(SPAN) + " junk", "malformed"),
    ("[null]", "malformed"),
    ("!!not-base64", "undecodable"),
    ("YWJj\nZGVm", "undecodable"),
    (base64.b64encode(b"\x0a\x0b").decode(), "unsupported_format"),
    (base64.b64encode(listed(SPAN)[1:-1].encode()).decode(), "unsupported_format"),
    (base64.b64encode(b"[\xff\xfe]").decode(), "malformed"),
]


def test_outcomes(spark):
    assert outcomes(spark, *[b for b, _ in BODIES]) == [o for _, o in BODIES]


def test_deletes_and_counts(spark):
    routed = ingest.ingest_messages(messages(spark, "", "!!", "[bad]", listed(SPAN), listed(SPAN), listed(SPAN)),
        F.when(F.col("message_id") == "4", "down").when(F.col("message_id") == "5", "illegal_argument"))
    rows = [(r["outcome"], r["counted"], r["delete"]) for r in routed.orderBy("message_id").collect()]
    assert rows == [
        ("skipped", False, False), ("undecodable", False, True), ("malformed", True, True),
        ("accepted", True, True), ("retry", True, False), ("malformed", True, True),
    ]


def test_metrics_count_after_unwrapping(spark):
    one, bad = listed(SPAN), "[three spans, none of them JSON]"
    routed = ingest.ingest_messages(messages(
        spark, one, base64.b64encode(one.encode()).decode(), bad, "!!", ""))
    row = metrics.collector_metrics(routed).first()
    assert row.asDict() == {
        "transport": "sqs", "messages": 3, "bytes": 2 * len(one) + len(bad), "messages_dropped": 1, "spans": 2,
    }


def test_v2_fields(spark):
    full = {
        "traceId": "5AF7183FB1D4CF5F", "parentId": "6B221D5BC9E6496C", "id": "352BFF9A74CA9AD2",
        "kind": "SERVER", "name": "get /", "timestamp": 1, "duration": 2,
        "localEndpoint": {"serviceName": "web", "ipv4": "10.0.0.1", "port": 80},
        "remoteEndpoint": {"ipv6": "::1"},
        "annotations": [{"timestamp": 3, "value": "foo"}],
        "tags": {"a": "b", "gone": None}, "debug": True, "shared": True,
    }
    row = ingest.decode_spans(ingest.ingest_messages(messages(spark, listed(full)))).first().asDict(True)
    assert row == {
        "trace_id": "5af7183fb1d4cf5f", "parent_id": "6b221d5bc9e6496c", "id": "352bff9a74ca9ad2",
        "kind": "SERVER", "name": "get /", "timestamp": 1, "duration": 2,
        "local_service": "web", "local_ipv4": "10.0.0.1", "local_ipv6": None, "local_port": 80,
        "remote_service": None, "remote_ipv4": None, "remote_ipv6": "::1", "remote_port": None,
        "annotations": [{"timestamp": 3, "value": "foo"}], "tags": {"a": "b"},
        "debug": True, "shared": True, "transport": "sqs", "message_id": "0",
    }


def test_ids_are_padded(spark):
    body = listed({"traceId": "a" * 17, "id": "B", "parentId": "b"})
    row = ingest.decode_spans(ingest.ingest_messages(messages(spark, body))).first()
    assert (row["trace_id"], row["id"], row["parent_id"]) == ("0" * 15 + "a" * 17, "0" * 15 + "b", None)


def test_v1_both_ends(spark):
    web, api = {"serviceName": "web"}, {"serviceName": "api"}
    body = listed({
        "traceId": "1", "id": "2", "name": "call", "timestamp": 100, "duration": 50,
        "annotations": [
            {"timestamp": 100, "value": "cs", "endpoint": web},
            {"timestamp": 110, "value": "sr", "endpoint": api},
            {"timestamp": 120, "value": "half", "endpoint": api},
            {"timestamp": 140, "value": "ss", "endpoint": api},
            {"timestamp": 150, "value": "cr", "endpoint": web},
        ],
        "binaryAnnotations": [
            {"key": "sa", "value": True, "endpoint": api}, {"key": "k", "value": "v", "endpoint": web},
        ],
    })
    spans = ingest.decode_spans(ingest.ingest_messages(messages(spark, body)))
    rows = {r["kind"]: r for r in spans.collect()}
    client, server = rows["CLIENT"], rows["SERVER"]
    assert (client["timestamp"], client["duration"], client["local_service"], client["remote_service"]) == (100, 50, "web", "api")
    assert (server["timestamp"], server["duration"], server["local_service"], server["shared"]) == (110, 30, "api", True)
    assert client["tags"] == {"k": "v"} and [a["value"] for a in client["annotations"]] == ["half"]


def test_layouts_may_mix(spark):
    v1 = {"traceId": "1", "id": "2", "name": "x", "annotations": [],
          "binaryAnnotations": [{"key": "lc", "value": "", "endpoint": {"serviceName": "w"}}]}
    routed = ingest.ingest_messages(messages(spark, listed(SPAN, v1)))
    assert ingest.decode_spans(routed).count() == 2
    assert ingest.decode_spans_v2(routed).count() == ingest.decode_spans_v1(routed).count() == 1


def test_every_message_ends_somewhere(spark, sf_dir):
    source = inputs.queue_messages(spark, sf_dir)
    routed = ingest.ingest_messages(source)
    counts = {r["outcome"]: r["count"] for r in routed.groupBy("outcome").count().collect()}
    assert sum(counts.values()) == source.count()
    assert set(counts) == {"accepted", "skipped", "malformed", "undecodable"}


def test_sampling_keeps_whole_traces(spark, make_spans):
    spans = make_spans(*[{"trace_id": f"{t:032x}", "id": f"{i:016x}"} for t in range(400) for i in range(2)])
    kept = ingest.sample_traces(spans, 0.5).groupBy("trace_id").count().collect()
    assert 120 < len(kept) < 280 and {r["count"] for r in kept} == {2}
    assert ingest.sample_traces(spans, 1.0).count() == 800
    assert ingest.sample_traces(spans.withColumn("debug", F.lit(True)), 0.0).count() == 800
    with pytest.raises(ValueError):
        ingest.sample_traces(spans, 2.0)


def test_bodies_round_trip(spark):
    texts = ["[]", listed(SPAN), '[{"error":"💩"}]', "[" + "é" * 300 + "]"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    body = payload.encode_body(F.col("t"))
    rows = df.select("t", body, payload.decode_transport(body).cast("string")).collect()
    assert [r[2] for r in rows] == texts
    assert [r[1] == r[0] for r in rows] == [True, True, False, False]
    assert "\n" not in rows[3][1]


def test_payload_is_parsed_once(spark):
    plan = ingest.decode_spans_v2(ingest.ingest_messages(messages(spark, listed(SPAN))))
    physical = plan._jdf.queryExecution().executedPlan().toString()
    assert physical.count("from_json") == 1 and "Exchange" not in physical
