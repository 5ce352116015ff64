import json

import pytest
from pyspark.sql import functions as F

from spanloom import schema, session
from spanloom.operators import calls, ingest, metrics
from spanloom.plans import inputs
from spanloom.sources import readers, sinks
from spanloom.streaming import ingest as jobs
from spanloom.streaming import state


@pytest.fixture
def run_dir(spark):
    return session.new_run_dir(spark, "test")


def rows(df):
    return sorted(map(str, df.collect()))


def test_stream_equals_batch_and_conserves(spark, sf_dir, run_dir):
    source = inputs.queue_messages(spark, sf_dir)
    sinks.write_queue_messages(source.repartition(5, "message_id"), f"{run_dir}/in")
    stream = readers.stream_queue_messages(spark, f"{run_dir}/in", max_batch=2)
    jobs.stream_ingest(stream, f"{run_dir}/out", f"{run_dir}/cp", True).awaitTermination()
    routed = ingest.ingest_messages(source)
    assert rows(jobs.stored_spans(spark, f"{run_dir}/out")) == rows(ingest.decode_spans(routed))
    outcomes = jobs.stored_outcomes(spark, f"{run_dir}/out")
    assert outcomes.count() == source.count()
    assert outcomes.select("batch").distinct().count() == 3
    rejected = jobs.stored_quarantine(spark, f"{run_dir}/out").count()
    assert rejected == routed.filter("outcome <> 'accepted'").count()


def test_repeating_a_micro_batch_leaves_no_second_copy(spark, sf_dir, run_dir):
    routed = ingest.ingest_messages(inputs.queue_messages(spark, sf_dir))
    for _ in range(2):
        jobs.write_outcomes(routed, 7, run_dir)
    assert jobs.stored_spans(spark, run_dir).count() == ingest.decode_spans(routed).count()
    assert jobs.stored_outcomes(spark, run_dir).count() == routed.count()


def test_restart_continues_from_the_checkpoint(spark, run_dir):
    def deliver(name, *ids):
        sinks.write_queue_messages(spark.createDataFrame(
            [(i, "r", "sqs", json.dumps([{"traceId": "1", "id": i}]), None) for i in ids], schema.QUEUE_MESSAGE,
        ), f"{run_dir}/in/{name}")
        stream = readers.stream_queue_messages(spark, f"{run_dir}/in/*")
        jobs.stream_ingest(stream, f"{run_dir}/out", f"{run_dir}/cp", True).awaitTermination()
        return jobs.stored_spans(spark, f"{run_dir}/out").count()

    assert [deliver("a", "1", "2"), deliver("b", "3")] == [2, 3]


def test_stored_windows_equal_batch_open_ones_included(spark, sf_dir, run_dir):
    source = inputs.queue_messages(spark, sf_dir)
    # in order of time, so that no message comes behind the watermark
    sinks.write_queue_messages(source.repartitionByRange(3, "received_at"), f"{run_dir}/in")
    routed = ingest.ingest_messages(readers.stream_queue_messages(spark, f"{run_dir}/in", max_batch=1))
    windows = state.metrics_stream(routed, "400 days", length="1 hour", slide="30 minutes")
    state.upsert_to(windows, f"{run_dir}/out", f"{run_dir}/cp", True).awaitTermination()
    batch = metrics.metrics_by_window(ingest.ingest_messages(source), length="1 hour", slide="30 minutes")
    assert rows(state.newest(spark, f"{run_dir}/out").select(batch.columns)) == rows(batch)


@pytest.fixture(params=[{}, session.CLUSTER_SETTINGS], ids=["memory", "cluster"])
def state_settings(spark, request):
    before = {k: spark.conf.get(k) for k in request.param}
    for k, v in request.param.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_redelivered_spans_are_dropped(spark, run_dir, state_settings):
    body = json.dumps([{"traceId": "1", "id": "2", "timestamp": 5, "tags": {"a": "b"}}])
    other = json.dumps([{"traceId": "1", "id": "2", "timestamp": 5, "tags": {"a": "c"}}])
    sinks.write_queue_messages(spark.createDataFrame(
        [(str(i), "r", "sqs", b, None) for i, b in enumerate([body, body, other, body])],
        schema.QUEUE_MESSAGE).repartition(4, "message_id"), f"{run_dir}/in")
    stream = readers.stream_queue_messages(spark, f"{run_dir}/in", max_batch=1)
    unique = state.dedup_stream(ingest.decode_spans(ingest.ingest_messages(stream)))
    state.append_to(unique, f"{run_dir}/out", f"{run_dir}/cp", True).awaitTermination()
    assert sorted(r["tags"]["a"] for r in spark.read.parquet(f"{run_dir}/out").collect()) == ["b", "c"]


def test_old_and_undated_spans_are_not_late(spark, run_dir):
    """Three micro-batches: recent spans, old and undated ones, and all of them once more."""
    day = 86_400_000_000
    times = {"a": 20_000 * day, "b": 20_001 * day, "c": 20_001 * day - day // 24, "d": None, "e": 5}
    for n, names in enumerate(["ab", "cde", "abcde"]):
        body = json.dumps([
            {"traceId": "1", "id": x, **({"timestamp": times[x]} if times[x] else {})} for x in names])
        sinks.write_queue_messages(spark.createDataFrame(
            [(str(n), "r", "sqs", body, None)], schema.QUEUE_MESSAGE).coalesce(1), f"{run_dir}/in/{n}")
        stream = readers.stream_queue_messages(spark, f"{run_dir}/in/*", max_batch=1)
        unique = state.dedup_stream(ingest.decode_spans(ingest.ingest_messages(stream)))
        state.append_to(unique, f"{run_dir}/out", f"{run_dir}/cp", True).awaitTermination()
    assert sorted(int(r["id"], 16) for r in spark.read.parquet(f"{run_dir}/out").collect()) == [10, 11, 12, 13, 14]


EVENT = ", ".join(f"{c} string" for c in calls.CALL_COLUMNS) + f", event {calls._EVENT}"


def test_calls_are_paired_across_micro_batches(spark, run_dir):
    """Send and receive arrive in different micro-batches; one call never gets its answer."""
    second = 1_000_000

    def event(call, at, no, phase, status=None):
        return (call, "svc", "GetRequest", "t" * 32, None, (at * second, no, phase, status))

    arrivals = [
        [event("a", 1, 1, 0), event("b", 2, 1, 0)],
        [event("a", 3, 1, 1, 500), event("a", 4, 2, 0)],
        [event("a", 5, 2, 1, 200)],
        # much later traffic moves the watermark on
        [event("z", 10_000, 1, 0)], [event("z", 10_001, 1, 1, 200)],
    ]
    stream_in = f"{run_dir}/in"
    for i, batch in enumerate(arrivals):
        spark.createDataFrame(batch, EVENT).coalesce(1).write.mode("append").parquet(stream_in)
        events = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(stream_in)
        state.append_to(state.pair_call_events(events), f"{run_dir}/out", f"{run_dir}/cp", True).awaitTermination()
    found = {r["timestamp"]: r for r in spark.read.parquet(f"{run_dir}/out").collect()}
    assert set(found) == {second, 2 * second}
    a, b = found[second], found[2 * second]
    assert a["duration"] == 4 * second
    assert "error" not in a["tags"]
    assert b["duration"] is None
    # parts of calls by micro-batch: the same as the whole table, unfinished and slow calls included
    everything = [e for batch in arrivals for e in batch] + [event("b", 90_000, 1, 1, 200)]
    spark.createDataFrame(everything[-1:], EVENT).coalesce(1).write.mode("append").parquet(stream_in)
    events = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(stream_in)
    state.stream_call_parts(events, f"{run_dir}/parts", f"{run_dir}/cp-parts", True).awaitTermination()
    stored = state.stored_calls(spark, f"{run_dir}/parts")
    assert rows(stored) == rows(state.pair_call_events(spark.createDataFrame(everything, EVENT)))
    assert {r["duration"] for r in stored.collect()} == {4 * second, 89_998 * second, second}
    # the same events as a table: a gap of any length leaves one span
    slow = spark.createDataFrame([event("s", 1, 1, 0), event("s", 9_000, 1, 1, 200)], EVENT)
    (span,) = state.pair_call_events(slow).collect()
    assert span["duration"] == 8_999 * second


def test_sampler_own_sink_and_counters(spark, sf_dir, run_dir):
    source = inputs.queue_messages(spark, sf_dir)
    sinks.write_queue_messages(source, f"{run_dir}/in")
    stream = readers.stream_queue_messages(spark, f"{run_dir}/in")
    jobs.stream_ingest(
        stream, f"{run_dir}/out", f"{run_dir}/cp", True, lambda spans: ingest.sample_traces(spans, 0.5)
    ).awaitTermination()
    expected = ingest.sample_traces(ingest.decode_spans(ingest.ingest_messages(source)), 0.5)
    assert rows(jobs.stored_spans(spark, f"{run_dir}/out")) == rows(expected)

    seen = []
    routed = metrics.observed(ingest.ingest_messages(stream))
    query = jobs.run(routed, lambda batch, n: seen.append(batch.count()), f"{run_dir}/cp2", True)
    query.awaitTermination()
    assert sum(seen) == source.count()
    total = metrics.collector_metrics(ingest.ingest_messages(source)).agg(F.sum("messages")).first()[0]
    assert sum(p["observedMetrics"]["collector"]["messages"] for p in query.recentProgress if p["observedMetrics"]) == total


def test_failed_sink_is_retried_from_the_checkpoint(spark, run_dir):
    body = json.dumps([{"traceId": "1", "id": "2"}])
    sinks.write_queue_messages(
        spark.createDataFrame([("1", "r", "sqs", body, None)], schema.QUEUE_MESSAGE), f"{run_dir}/in")
    routed = ingest.ingest_messages(readers.stream_queue_messages(spark, f"{run_dir}/in"))

    def down(batch, batch_id):
        raise OSError("storage is down")

    with pytest.raises(Exception):
        jobs.run(routed, down, f"{run_dir}/cp", True).awaitTermination()
    jobs.run(routed, jobs.folder_sink(f"{run_dir}/out"), f"{run_dir}/cp", True).awaitTermination()
    assert jobs.stored_spans(spark, f"{run_dir}/out").count() == 1


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert session.new_run_dir(spark, "x") != session.new_run_dir(spark, "x")
