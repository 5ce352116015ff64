import json

import pytest
from pyspark.sql import functions as F

from spanloom import schema
from spanloom.operators import ingest, packing
from spanloom.plans import inputs
from spanloom.sources import readers, sinks

LIMIT = 16 * 1024


@pytest.fixture(scope="module")
def mixed(spark):
    """Small, large and oversized spans of a host with nine tenths of all, and of three others."""
    rows = []
    for i in range(1000):
        tags = {"note": "y" * (i % 40), "e": "é" if i % 7 == 0 else "e"}
        if i % 50 == 0:
            tags["note"] = "z" * 900
        if i % 200 == 0:
            tags["note"] = "z" * (20_000 if i % 400 == 0 else 9_000)
        row = {"trace_id": f"{i // 3:032x}", "id": f"{i:016x}", "kind": "CLIENT", "tags": tags,
               "annotations": [], "local_service": f"host{i % 10 if i % 10 < 3 else 9}"}
        rows.append(tuple(row.get(f) for f in schema.SPAN_FIELDS))
    spans = spark.createDataFrame(rows, schema.SPAN).cache()
    return spans


def packed(spans, base64=True, buckets=16):
    return packing.pack_spans(
        packing.encode_spans(spans, F.col("local_service")), LIMIT, base64, buckets
    )


def test_packed_spans_come_back(spark, mixed, tmp_path):
    result = packed(mixed)
    assert result.groupBy("packing").count().count() == 4
    sinks.write_queue_messages(packing.queue_messages(result).select(
        F.col("batch").alias("message_id"), F.lit("r").alias("receipt_handle"),
        F.lit("sqs").alias("transport"), "body", F.lit(None).cast("timestamp").alias("received_at"),
    ), str(tmp_path / "q"))
    routed = ingest.ingest_messages(readers.read_queue_messages(spark, str(tmp_path / "q")))
    assert {r["outcome"] for r in routed.select("outcome").distinct().collect()} == {"accepted"}
    back = ingest.decode_spans(routed).select("trace_id", "id", "local_service", F.to_json("tags"))
    lost = packing.oversize_spans(result).select("trace_id", "id")
    sent = mixed.join(lost, ["trace_id", "id"], "left_anti").select(
        "trace_id", "id", "local_service", F.to_json("tags"))
    assert lost.count() == 3
    sinks.write_oversize(packing.oversize_spans(result), str(tmp_path / "lost"))
    kept = spark.read.parquet(str(tmp_path / "lost"))
    assert {len(json.loads(r["json"])["tags"]["note"]) for r in kept.collect()} == {20_000}
    assert back.exceptAll(sent).count() == 0 and sent.exceptAll(back).count() == 0


def test_every_message_fits(mixed):
    for base64 in (True, False):
        result = packed(mixed, base64)
        rows = packing.queue_messages(result).collect()
        for r in rows:
            assert r["list_bytes"] <= packing.usable_bytes(LIMIT, base64)
            assert not base64 or len(r["body"]) <= LIMIT
        # no more messages than the running sizes fill, plus the spans that travel alone
        most = result.filter(F.col("packing") == packing.ALONE).count()
        for label, part in ((packing.SHARED, packing.SHARED_PART), (packing.LARGE, packing.LARGE_PART)):
            step = packing.largest_and_step(LIMIT, base64, part)[1]
            totals = result.filter(F.col("packing") == label).groupBy("pack_key").agg(F.sum("size")).collect()
            most += sum(-(-r[1] // step) for r in totals)
        assert len(rows) <= most


def test_messages_of_ordinary_spans_are_full(mixed):
    """All but the last message of a host hold nine tenths of what they may."""
    for base64 in (True, False):
        lists = packing.queue_messages(packed(mixed, base64).filter("packing = 'shared'")).collect()
        last = {}
        for r in lists:
            last[r["pack_key"]] = max(last.get(r["pack_key"], 0), int(r["batch"][1:]))
        full = [r["list_bytes"] for r in lists if int(r["batch"][1:]) < last[r["pack_key"]]]
        assert len(full) > 5 and sum(full) / len(full) >= 0.9 * packing.usable_bytes(LIMIT, base64)


def test_running_size_equals_one_long_sum(mixed):
    """The two-level sum gives the batches of a single sum over each host, whatever the buckets."""
    from spanloom.functions import ids

    for buckets in (1, 7):
        largest, step = packing.largest_and_step(LIMIT, True, packing.SHARED_PART)
        keyed = packing.encode_spans(mixed, F.col("local_service")).withColumn(
            "bucket", ids.digest_number(F.col("trace_id"), F.col("id")) % buckets)
        expected, sums = {}, {}
        for r in sorted(keyed.collect(), key=lambda r: (r["bucket"], r["trace_id"], r["id"])):
            if r["size"] <= largest:
                sums[r["pack_key"]] = sums.get(r["pack_key"], 0) + r["size"]
                expected[r["id"]] = f"b{(sums[r['pack_key']] - 1) // step}"
        actual = packed(mixed, buckets=buckets).filter("packing = 'shared'").collect()
        assert {r["id"]: r["batch"] for r in actual} == expected


def test_records_and_keys(spark, mixed):
    records = packing.stream_records(packed(mixed, base64=False))
    assert set(records.columns) == {"partition_key", "batch", "span_count", "list_bytes", "data"}
    row = records.first()
    assert len(json.loads(bytes(row["data"]))) == row["span_count"]
    keys = spark.range(1).select(
        packing.partition_key(F.lit("h"), F.lit("p")),
        packing.partition_key(F.lit(None).cast("string"), F.lit("p")),
    ).first()
    assert keys[0] == "h" and [len(x) for x in keys[1].split("-")] == [8, 4, 4, 4, 12]


def test_size_estimate(spark):
    from spanloom.functions.payload import base64_size_estimate

    sizes = [0, 1, 2, 3, 1000, 196_606, 1 << 40]
    df = spark.createDataFrame([(n,) for n in sizes], "n bigint")
    assert [r[0] for r in df.select(base64_size_estimate(F.col("n"))).collect()] == [(n + 2) * 4 // 3 for n in sizes]
    assert packing.usable_bytes(packing.QUEUE_MAX_BYTES, True) == 196_606


def test_busy_host_is_spread(spark, sf_dir):
    """Running sums are partitioned by host and bucket, never by host alone."""
    spans = inputs.root_spans(spark, sf_dir)
    plan = packed(spans)._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning(pack_key" in line]
    assert sum("bucket" in line for line in wide) >= 2
    # the only exchange on the host alone carries per-bucket totals
    assert sum("bucket" not in line for line in wide) == 1


@pytest.mark.parametrize("few_keys", [True, False])
def test_reports_and_sums_share_one_shuffle(spark, few_keys):
    """The first report is packed and messages are those of unique spans, whichever way the sums arrive."""
    rows = [(f"k{n % 3}", f"{n % 97:032x}", f"{n:016x}", None, "x" * (20 + 13 * n % 400)) for n in range(1500)]
    later = [(f"k{n % 2}", t, i, kind, text + "y") for n, (_, t, i, kind, text) in enumerate(rows[:500])]
    columns = "pack_key string, trace_id string, id string, kind string, json string"

    def sized(held):
        df = spark.createDataFrame(held, columns)
        return df.withColumn("size", (F.octet_length("json") + 1).cast("bigint"))

    plain = packing.queue_messages(packing.pack_spans(sized(rows), 8192, True, 16).drop("bucket", "split"))
    packed = packing.pack_spans(sized(rows + later), 8192, True, 16, [F.col("json")], few_keys)
    assert sorted(packing.queue_messages(packed).collect()) == sorted(plain.collect())
    assert 0 < packed.filter("split").count() < packed.count()
    if few_keys:
        plan = packed._jdf.queryExecution().executedPlan().toString()
        # spans by bucket, for each of two readers that share it when it runs, and sums by key
        assert plan.count("Exchange hashpartitioning(bucket") == 2
        assert plan.count("Exchange hashpartitioning(pack_key") == 1
