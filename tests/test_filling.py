import json
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from spanloom.operators import filling, packing

LIMIT = 16 * 1024
ENCODED = "pack_key string, trace_id string, id string, kind string, json string, size bigint"


def make(spark, sizes_of, seed=1):
    """Encoded spans with bodies of given sizes, by key."""
    rng, rows = random.Random(seed), []
    for key, sizes in sizes_of.items():
        for size in sizes:
            text = json.dumps("x" * (size - 3))
            rows.append((key, f"{rng.getrandbits(128):032x}", f"{len(rows):016x}",
                         rng.choice(["CLIENT", None]), text, len(text) + 1))
    return spark.createDataFrame(rows, ENCODED)


@pytest.fixture(scope="module")
def sizes():
    rng = random.Random(5)
    kinds = [lambda: rng.randint(60, 760), lambda: rng.randint(770, 6000), lambda: rng.randint(6001, 12_280)]
    return {
        # a third of all bytes, of all sizes; only small ones; only large ones; one span; no span that fits
        "hot": [rng.choices(kinds, [30, 3, 1])[0]() for _ in range(4000)],
        "small": [kinds[0]() for _ in range(800)], "large": [kinds[1]() for _ in range(400)],
        "one": [5], "none": [13_000, 20_000],
    }


@pytest.fixture(scope="module", params=[True, False], ids=["base64", "text"])
def filled(request, spark, sizes):
    result = filling.fill_messages(make(spark, sizes), LIMIT, request.param, 64 * 1024)
    return request.param, [r.asDict() for r in result.collect()]


def messages(rows):
    found = defaultdict(list)
    for r in rows:
        if r["batch"] is not None:
            found[r["pack_key"], r["batch"]].append(r)
    return found


def test_every_span_once_and_every_message_fits(spark, sizes, filled):
    base64, rows = filled
    assert sorted((r["pack_key"], r["size"] - 1) for r in rows) == sorted((k, n - 1) for k, v in sizes.items() for n in v)
    assert len({r["id"] for r in rows}) == len(rows)
    room, small = filling.room_and_small(LIMIT, base64)
    for r in rows:
        assert (r["batch"] is None) == (r["packing"] == "oversize") == (r["size"] > room)
        assert (r["packing"] == "shared") == (r["size"] <= small)
    for members in messages(rows).values():
        assert sum(m["size"] for m in members) <= room
        large = [m for m in members if m["size"] > small]
        # spans of one class make up a message, so many as fit of its largest size
        assert len({room // m["size"] for m in large}) <= 1
        assert not large or len(large) <= room // large[0]["size"]


def test_messages_are_full(filled):
    base64, rows = filled
    room, _ = filling.room_and_small(LIMIT, base64)
    held = defaultdict(list)
    for (key, batch), members in messages(rows).items():
        held[key].append(sum(m["size"] for m in members))
    # but for the last message of a class; a key of small spans has one class
    assert sum(held["small"]) >= 0.9 * room * (len(held["small"]) - 1)
    assert sum(held["hot"]) / len(held["hot"]) >= 0.9 * room
    # without small spans a class gives k / (k + 1) at least, half-full messages at most a last one each
    counted = messages([r for r in rows if r["pack_key"] == "large"])
    for k in range(1, 16):
        totals = sorted(sum(m["size"] for m in v) for (_, b), v in counted.items() if b.startswith(f"c{k}-"))
        assert all(t > room * k / (k + 1) for t in totals[1:])


def test_same_as_one_walk_over_each_key(filled):
    """Places from blocks and buckets are those of a plain walk in the same order."""
    import hashlib

    base64, rows = filled
    room, small = filling.room_and_small(LIMIT, base64)
    by_key = defaultdict(list)
    for r in rows:
        if r["size"] <= room:
            by_key[r["pack_key"]].append(r)
    for members in by_key.values():
        buckets = -(-sum(m["size"] for m in members) // (64 * 1024))
        digest = lambda m: int(hashlib.md5(f"{m['trace_id']}:{m['id']}".encode()).hexdigest()[:15], 16) % buckets
        members.sort(key=lambda m: (digest(m), m["trace_id"], m["id"]))
        classes = defaultdict(list)
        for m in members:
            classes[min(16, room // m["size"])].append(m)
        gaps = []
        for k in range(1, 16):
            for first in range(0, len(classes[k]), k):
                group = classes[k][first:first + k]
                assert {m["batch"] for m in group} == {f"c{k}-{first // k}"}
                length = room - sum(m["size"] for m in group) - small + 1
                if length > 0:
                    gaps.append((f"c{k}-{first // k}", length))
        # the small spans' starts walk over the gaps, then over messages of their own
        ends, at = [], 0
        for name, length in gaps:
            at += length
            ends.append((at, name))
        start, i = 0, 0
        for m in classes[16]:
            while i < len(ends) and ends[i][0] <= start:
                i += 1
            own = f"b{(start - at) // (room - small + 1)}"
            assert m["batch"] == (ends[i][1] if i < len(ends) else own)
            start += m["size"]


def test_result_makes_messages(spark, sizes):
    result = filling.fill_messages(make(spark, sizes), LIMIT, True, 64 * 1024)
    made = packing.queue_messages(result).agg(
        F.sum("span_count"), F.max("list_bytes"), F.max(F.octet_length("body"))).first()
    assert made[0] == sum(len(v) for v in sizes.values()) - 2
    assert made[1] <= packing.usable_bytes(LIMIT, True) and made[2] <= LIMIT


def test_small_blocks_change_nothing(spark, sizes, monkeypatch):
    rows = lambda: sorted((r["id"], r["batch"]) for r in filling.fill_messages(
        make(spark, sizes), LIMIT, True, 64 * 1024).filter("batch is not null").collect())
    before = rows()
    monkeypatch.setattr(filling, "BLOCK_MESSAGES", 2)
    assert rows() == before


def test_hot_key_is_spread_by_its_bytes(spark, sizes):
    """No exchange or window is by the key alone but for totals of blocks."""
    plan = filling.fill_messages(make(spark, sizes), LIMIT)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "row_number" in line and "Window [" in line]
    assert windows and all("bucket" in line.split("specifiedwindow")[-1] or "bucket" in line for line in windows)


def test_no_spans(spark):
    empty = spark.createDataFrame([], ENCODED)
    result = filling.fill_messages(empty, LIMIT)
    assert result.columns == [*empty.columns, "packing", "batch"] and result.count() == 0
