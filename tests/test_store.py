import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from spanloom import schema
from spanloom.operators import dedup, joins, store
from spanloom.plans import inputs


@pytest.fixture(scope="module")
def spans_list():
    rng = random.Random(7)
    rows = []
    for t in range(60):
        ids = []
        for i in range(rng.randint(1, 12)):
            row = {
                "trace_id": f"{t + 1:032x}", "id": f"{i + 1:016x}",
                "parent_id": rng.choice(ids) if ids else None,
                "kind": rng.choice(["CLIENT", "SERVER", "PRODUCER", "CONSUMER", None]),
                "name": rng.choice(["get", "put", None]),
                "timestamp": rng.choice([None, 1_000_000 + rng.randint(0, 999_999)]),
                "duration": rng.choice([None, rng.randint(1, 1000)]),
                "local_service": rng.choice(["web", "api", "db", None]),
                "remote_service": rng.choice(["api", "db", None]),
                "tags": rng.choice([{}, {"error": "x"}, {"http.status_code": "503"}, {"http.status_code": "404"}]),
                "annotations": [],
            }
            ids.append(row["id"])
            rows.append(row)
    return rows


@pytest.fixture(scope="module")
def spans(spark, spans_list):
    rows = [tuple(r.get(f) for f in schema.SPAN_FIELDS) for r in spans_list]
    return spark.createDataFrame(rows, schema.SPAN).cache()


def test_dependencies_against_brute_force(spans, spans_list):
    by_id = {(r["trace_id"], r["id"]): r for r in spans_list}
    links, errors = Counter(), Counter()
    for r in spans_list:
        parent = by_id.get((r["trace_id"], r["parent_id"]))
        child = {"CLIENT": r["remote_service"], "PRODUCER": r["remote_service"],
                 "SERVER": r["local_service"], "CONSUMER": r["local_service"]}.get(r["kind"])
        if parent is None or parent["local_service"] is None or child is None or r["timestamp"] is None:
            continue
        if not 1_200_000 <= r["timestamp"] <= 1_900_000:
            continue
        edge = (parent["local_service"], child)
        links[edge] += 1
        errors[edge] += "error" in r["tags"] or r["tags"].get("http.status_code") == "503"
    rows = store.get_dependencies(spans, end_ts=1900, lookback=700).collect()
    assert {(r["parent"], r["child"]): (r["call_count"], r["error_count"]) for r in rows} == {
        e: (n, errors[e]) for e, n in links.items()
    }


@pytest.mark.parametrize("limit", [1, 5, 20_000])
def test_traces_against_brute_force(spans, spans_list, limit):
    traces = {}
    for r in spans_list:
        traces.setdefault(r["trace_id"], []).append(r)
    found = []
    for trace_id, members in traces.items():
        times = [m["timestamp"] for m in members if m["timestamp"] is not None]
        hit = any(m["local_service"] == "web" and m["name"] == "get" and (m["duration"] or 0) >= 100
                  and (m["duration"] or 0) <= 900 for m in members)
        if hit and times and 1_000_000 <= min(times) <= 1_500_000:
            found.append((-min(times), trace_id))
    expected = {t for _, t in sorted(found)[:limit]}
    result = store.get_traces(spans, limit=limit, end_ts=1500, lookback=500, service="web",
                              span_name="get", min_duration=100, max_duration=900)
    rows = result.collect()
    assert {r["trace_id"] for r in rows} == expected
    assert len(rows) == sum(len(traces[t]) for t in expected)


def test_names_and_one_trace(spans, spans_list):
    assert [r[0] for r in store.get_service_names(spans).collect()] == ["api", "db", "web"]
    assert [r[0] for r in store.get_span_names(spans, "web").collect()] == ["get", "put"]
    wanted = f"{3:032x}"
    expected = [r for r in spans_list if r["trace_id"] == wanted]
    assert len(store.get_trace(spans, wanted.upper()).collect()) == len(expected)
    assert store.get_trace(spans, f"{3:016x}").count() == 0
    assert store.get_trace(spans, f"{3:016x}", strict=False).count() == len(expected)


def test_dedup_keeps_one_and_the_earliest(make_spans):
    base = {"trace_id": "t", "id": "1", "kind": "CLIENT", "timestamp": 5, "tags": {"a": "1", "b": "2"}}
    spans = make_spans(base, {**base, "tags": {"b": "2", "a": "1"}, "message_id": "m2"}, {**base, "timestamp": 4},
                       {**base, "kind": "SERVER"}, {**base, "timestamp": None})
    rows = {r["kind"]: r["timestamp"] for r in dedup.dedup_spans(spans).collect()}
    assert rows == {"CLIENT": 4, "SERVER": 5}
    hashes = spans.limit(2).select(dedup.content_hash(spans.columns)).distinct().count()
    assert hashes == 1


def test_dedup_thins_out_before_the_shuffle(spans):
    plan = dedup.dedup_spans(spans)._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.rindex("Partial"), plan.rindex("Exchange")
    assert "WindowGroupLimit" in plan and partial > exchange  # below it in the printed tree


def test_dependencies_count_before_the_join(spans):
    plan = store.get_dependencies(spans, 1900, 700)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.rindex("Aggregate")


@pytest.mark.parametrize("period", store.PERIODS)
def test_stored_layout_answers_alike_and_prunes(spark, spans, spans_list, tmp_path, period):
    path = str(tmp_path / "store")
    day = 86_400_000_000
    # traces of every third number lie 400 days later
    shift = F.when(F.conv(F.substring("trace_id", -4, 4), 16, 10).cast("int") % 3 == 0, 400 * day).otherwise(0)
    moved = spans.withColumn("timestamp", F.col("timestamp") + shift)
    store.write_spans(moved, path, period)
    stored = store.read_spans(spark, path, period)

    def same(question):
        a, b = question(moved), question(stored)
        assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
        return b._jdf.queryExecution().executedPlan().toString()

    window = {"end_ts": 400 * 86_400_000 + 1900, "lookback": 1700}
    plan = same(lambda s: store.get_traces(s, service="web", min_duration=100, **window))
    assert f"PartitionFilters: [(isnull({period}" in plan and "PushedFilters: [IsNotNull(local_service)" in plan
    plan = same(lambda s: store.get_dependencies(s, **window))
    assert f"PartitionFilters: [isnotnull({period}" in plan and "LeftSemi" in plan
    slack = same(lambda s: store.get_dependencies(s, parent_slack=86_400_000, **window))
    assert f"PartitionFilters: [(isnull({period}" in slack
    for strict, wanted in ((True, f"{3:032x}"), (False, f"{3:016x}")):
        plan = same(lambda s: store.get_trace(s, wanted, strict))
        assert f"EqualTo(trace_low,{wanted[-16:]})" in plan


def test_correlation(spark, spans):
    known = f"{5:032x}"
    root = lambda t: f"Root=1-{t[:8]}-{t[8:]}"
    high = "0000000100000000" + "0" * 15 + "5"
    more = spans.filter(F.col("trace_id") == known).withColumn("trace_id", F.lit(high))
    logs = spark.createDataFrame(
        [("a", root(high)), ("b", root("f" * 32)), ("c", None), ("d", "junk"), ("e", root(high) + ";Sampled=1")],
        "request_id string, header string")
    rows = {r["request_id"]: (r["state"], r["span_count"]) for r in store.correlate_logs(logs, more).collect()}
    n = more.count()
    assert rows == {"a": ("traced", n), "b": ("unknown_trace", None), "c": ("untraced", None),
                    "d": ("untraced", None), "e": ("traced", n)}
    assert {r["request_id"] for r in store.untraced_requests(logs, more).collect()} == {"b", "c", "d"}


def test_hot_key_is_split_by_adaptive_execution(spark):
    """A key with a third of all rows, and nulls with another third, do not stay in one task."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
        "spark.sql.shuffle.partitions": "20",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = 120_000
        key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(
            F.col("id") % 3 == 1, F.concat(F.lit("k"), (F.col("id") % 5000).cast("string")))
        rows = spark.range(n, numPartitions=8).select(key.alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
        summary = rows.filter("k is not null").groupBy("k").agg(F.count("*").alias("seen"))
        joined = joins.left_join_summary(rows, summary, "k")
        seen = joined.groupBy().agg(F.count("*"), F.sum(F.when(F.col("k") == "hot", F.col("seen"))),
                                    F.count_if(F.col("k").isNull() & F.col("seen").isNull())).first()
        assert tuple(seen) == (n, (n // 3) ** 2, n // 3)
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_unique_store_moves_spans_once(spark, tmp_path):
    """Copies whose periods differ collapse as by ``dedup_spans``; odd and null keys stay; one shuffle."""
    years = [None, 0, 400 * 86_400_000_000, 900 * 86_400_000_000]
    rng = random.Random(3)
    rows = []
    for _ in range(600):
        row = dict.fromkeys(schema.SPAN_FIELDS)
        row.update(
            trace_id=rng.choice(["", None, *[f"{t:032x}" for t in range(40)], f"{7:016x}"]),
            id=rng.choice([None, "", *[f"{i:016x}" for i in range(4)]]),
            kind=rng.choice(["CLIENT", None]), timestamp=rng.choice(years), duration=rng.choice([None, 1, 2]),
            name=rng.choice(["a", None]), tags=rng.choice([None, {}, {"k": "v"}]),
        )
        rows.append(tuple(row.values()))
    spans = spark.createDataFrame(rows, schema.SPAN)
    store.write_unique_spans(spans, str(tmp_path / "store"), "year")
    stored = store.plain(store.read_spans(spark, str(tmp_path / "store"), "year"))

    def told(df):
        return Counter(r[0] for r in df.select(F.to_json(F.struct(*schema.SPAN_FIELDS))).collect())

    assert told(stored) == told(dedup.dedup_spans(spans))
    plan = store.unique_in_ranges(store.lay_out(spans, "year"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan


def test_redelivered_spans_join_the_tables_once(spark, sf_dir):
    delivered = inputs.delivered_spans(spark, sf_dir)
    plan = delivered._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 7
    once = inputs.spans(spark, sf_dir)
    again = once.filter(F.conv(F.substring("id", -12, 12), 16, 10).cast("bigint") % 5 == 1)
    assert delivered.count() == once.count() + again.count()
