"""What jobs of several steps leave on disk: their tables, and no shuffle of an earlier step."""

import contextlib
import os
import time

import pytest
from pyspark.sql import functions as F

from spanloom import schema, session
from spanloom.operators import links, packing, postings, store
from spanloom.plans import catalog, inputs
from spanloom.sources import sinks

DAY = 86_400_000_000
WINDOW = {"end_ts": 2 * DAY // 1000, "lookback": 2 * DAY // 1000}


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    found = {}
    for top in blocks.localDirsString():
        for folder, _, names in os.walk(top):
            for name in names:
                if name.startswith("shuffle_") and name.endswith(".data"):
                    with contextlib.suppress(FileNotFoundError):
                        found[name] = os.path.getsize(f"{folder}/{name}")
    return found


@contextlib.contextmanager
def new_shuffles(spark, wait=False):
    """The shuffle files that are there after the body and were not before; ``wait`` gives them time to go."""
    before, left = shuffle_files(spark), {}
    yield left
    for _ in range(50 if wait else 1):
        left.clear()
        left.update({k: v for k, v in shuffle_files(spark).items() if k not in before})
        if not left:
            break
        time.sleep(0.1)


@pytest.fixture
def spans(spark):
    """500 traces of four spans, each with a long tag that does not compress."""
    text = F.concat(*[F.sha2(F.concat("id", F.lit(f"-{i}")), 512) for i in range(8)])
    made = spark.range(2000).select(
        F.lpad(F.hex(F.floor(F.col("id") / 4)), 32, "0").alias("trace_id"),
        F.lpad(F.hex(F.col("id")), 16, "0").alias("id"),
        F.when(F.col("id") % 4 > 0, F.lpad(F.hex(F.col("id") - 1), 16, "0")).alias("parent_id"),
        F.lit("SERVER").alias("kind"), (F.lit(DAY) + F.col("id")).alias("timestamp"),
        F.concat(F.lit("s"), F.col("id") % 4).alias("local_service"),
        F.create_map(F.lit("same"), F.lit("1"), F.lit("text"), text).alias("tags"),
    )
    return schema.conform(made)


@pytest.fixture
def large_tables(spark):
    """Joins shuffle, as those of large tables do."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.fixture
def path(spark, spans):
    place = session.new_run_dir(spark, "disk-store")
    store.write_spans(spans, place)
    return place


def test_store_leaves_no_shuffle(spark, spans):
    for write in (store.write_spans, store.write_unique_spans):
        place = session.new_run_dir(spark, "disk-store")
        with new_shuffles(spark, wait=True) as left:
            write(spans.unionByName(spans.limit(0)), place)
        assert not left and spark.read.parquet(place).count() == 2000
    assert spark.conf.get(session._DROP_SHUFFLES) == "false"


def test_index_leaves_no_shuffle_and_moves_postings_once(spark, path, monkeypatch):
    index = session.new_run_dir(spark, "disk-index")
    with new_shuffles(spark, wait=True) as left:
        postings.build(spark, path, index)
    # what is counted on the way is small: files and terms, not postings
    assert sum(left.values()) < 20_000
    listed = postings._read(spark, index, postings.POSTINGS, "day")
    same = listed.filter(F.col("term") == postings.wanted_terms(None, None, {"same": "1"})[0])
    # a term that all spans of a trace have is listed once
    assert same.count() == same.select("trace_id").distinct().count() == 500
    written = listed.count()
    assert written == listed.distinct().count()
    monkeypatch.setattr(session, "dropping_shuffles", lambda spark: contextlib.nullcontext())
    again = session.new_run_dir(spark, "disk-index")
    with new_shuffles(spark) as kept:
        postings._replace(
            spark, postings.postings_of(store.read_spans(spark, path), "day"), again, "day", [],
            ["day", "term", "trace_id"], 4, once=True,
        )
    assert len({k.split("_")[1] for k in kept}) == 1


def test_links_move_no_tags_and_leave_no_shuffle(spark, path, large_tables, monkeypatch):
    stored = store.read_spans(spark, path)
    with new_shuffles(spark, wait=True) as left:
        found = links.service_links(stored, **WINDOW)
    # sizes of traces alone
    assert sum(left.values()) < 50_000
    rows = {(r.parent, r.child): (r.call_count, r.error_count) for r in found.collect()}
    assert rows == {(f"s{i}", f"s{i + 1}"): (500, 0) for i in range(3)}
    monkeypatch.setattr(session, "dropping_shuffles", lambda spark: contextlib.nullcontext())
    with new_shuffles(spark) as kept:
        links.service_links(stored, **WINDOW)
    # the tags alone are two million characters
    assert 0 < sum(kept.values()) < 700_000


def test_oversize_spans_move_once(spark, spans, monkeypatch):
    """Neither sums nor batches are made for them; spans without a key are in no message and not in quarantine."""
    monkeypatch.setattr(session, "dropping_shuffles", lambda spark: contextlib.nullcontext())
    number = F.conv(F.col("id"), 16, 10).cast("int")
    long = F.when(number % 100 == 0, F.repeat(F.lit("z"), 20_000)).otherwise(F.lit("z"))
    # every tenth span is reported twice; of every hundredth the first report has no key
    twice = spans.withColumn("tags", F.create_map(F.lit("note"), long)).withColumn("name", F.explode(
        F.when(number % 10 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("b")))))
    key = F.when((number % 200 != 0) | (F.col("name") != "a"), F.col("local_service"))
    reported = packing.encode_spans(twice, key)
    packed = packing.pack_spans(reported, 16 * 1024, first_by=[F.col("json")], few_keys=True)
    place = session.new_run_dir(spark, "disk-oversize")
    with new_shuffles(spark) as kept:
        sinks.write_oversize(packing.oversize_spans(packed), place)
    assert len({k.split("_")[1] for k in kept}) == 1
    found = {int(r.id, 16): r.json for r in spark.read.parquet(place).collect()}
    assert sorted(found) == list(range(100, 2000, 200)) and all('"name":"a"' in j for j in found.values())
    # the others are where they were
    assert packed.count() == 1990 and packed.filter("batch is null").count() == 10


def test_staged_spans_leave_no_shuffle(spark, spans, monkeypatch):
    monkeypatch.setattr(inputs, "spans", lambda spark, sf_dir: spans.unionByName(spans))
    with new_shuffles(spark, wait=True) as left:
        encoded = catalog._encoded(spark, "nowhere")
    assert not left and encoded.count() == 2000
