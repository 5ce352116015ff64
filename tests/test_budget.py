import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from spanloom import schema
from spanloom.operators import budget

SECOND = 1_000_000


@pytest.fixture(scope="module")
def rows():
    """Traces of three services in four seconds; one service holds most of them in one second."""
    rng, made = random.Random(3), []
    for t in range(900):
        trace = f"{rng.getrandbits(128):032x}"
        hot = t % 3 > 0
        at = SECOND * (1 if hot else rng.randrange(4)) + rng.randrange(SECOND)
        service = "hot" if hot else rng.choice(["web", "api", None])
        for i in range(rng.randint(1, 4)):
            made.append({
                "trace_id": trace, "id": f"{i:016x}", "parent_id": None if i == 0 else "0" * 16, "kind": "SERVER",
                # inner spans may be earlier than the first one, or have no time
                "timestamp": at if i == 0 else rng.choice([None, at - 5 * SECOND, at + SECOND]),
                "local_service": service if i == 0 else "inner", "tags": {}, "annotations": [],
            })
    # a trace without a root, one without any time, spans without a trace
    for trace, parent, at in (("a" * 32, "9", 2 * SECOND), ("b" * 32, None, None), (None, None, SECOND)):
        made.append({"trace_id": trace, "id": "1", "parent_id": parent, "timestamp": at, "local_service": "web",
                     "tags": {}, "annotations": []})
    return made


@pytest.fixture(scope="module")
def spans(spark, rows):
    return spark.createDataFrame([tuple(r.get(f) for f in schema.SPAN_FIELDS) for r in rows], schema.SPAN).cache()


def brute_force(rows, number):
    traces, groups = defaultdict(list), defaultdict(list)
    for r in rows:
        if r["trace_id"]:
            traces[r["trace_id"]].append(r)
    for trace, members in traces.items():
        first = min(members, key=lambda r: (r["parent_id"] is not None, r["timestamp"] is None, r["timestamp"] or 0, r["id"]))
        slot = None if first["timestamp"] is None else first["timestamp"] // SECOND
        number_of = int(hashlib.md5(trace.encode()).hexdigest()[:15], 16)
        groups[first["local_service"], slot].append((number_of, trace))
    kept = {}
    for (service, slot), members in groups.items():
        members.sort()
        weight = 2.0 ** 60 / members[number][0] if len(members) > number else 1.0
        kept |= {t: (service, slot, weight) for _, t in members[:number]}
    return kept


@pytest.mark.parametrize("number", [1, 7, 100, 5000])
def test_against_brute_force(spans, rows, number):
    found = budget.sample_traces(spans, number).collect()
    assert {r["trace_id"]: (r["service"], r["slot"], r["weight"]) for r in found} == brute_force(rows, number)
    assert len(found) == len({r["trace_id"] for r in found})


def test_traces_stay_whole(spans, rows):
    kept = brute_force(rows, 7)
    found = budget.sample_spans(spans, 7)
    assert found.columns == [*spans.columns[:1], *spans.columns[1:], "weight"]
    assert found.count() == sum(r["trace_id"] in kept for r in rows)


def test_weights_add_up(spark):
    """Estimated counts come close to the true ones, over a part that the sampling knows nothing of, too."""
    n = 60_000
    many = schema.conform(spark.range(n).select(
        F.md5(F.col("id").cast("string")).alias("trace_id"), F.lit("1").alias("id"),
        F.when(F.col("id") % 4 == 0, "x").otherwise("y").alias("name"), F.lit("hot").alias("local_service"),
        F.lit(SECOND).cast("bigint").alias("timestamp")))
    for number in (900, 2500):  # cut before the shuffle, and by parts
        found = budget.sample_spans(many, number)
        total, part, kept = found.agg(
            F.sum("weight"), F.sum(F.when(F.col("name") == "x", F.col("weight"))), F.count("*")).first()
        assert kept == number and abs(total / n - 1) < 0.12 and abs(part / (n / 4) - 1) < 0.2


def test_results_of_parts_merge(spans, rows):
    groups = budget.trace_groups(spans)
    halves = [budget.smallest(groups.filter(F.col("hash") % 2 == i), 7) for i in (0, 1)]
    merged = budget.merge(*halves, 7)
    # what is merged a second time changes nothing
    again = budget.merge(merged, halves[0], 7)
    for bottom in (merged, again):
        kept = budget.kept_traces(bottom, 7).collect()
        assert {r["trace_id"]: (r["service"], r["slot"], r["weight"]) for r in kept} == brute_force(rows, 7)


def test_hot_service_is_cut_before_the_shuffle(spans):
    for number, shuffles in ((7, 1), (5000, 2)):
        bottom = budget.smallest(spans.select("trace_id", F.col("local_service").alias("service"),
                                              F.lit(1).alias("slot"), F.xxhash64("trace_id").alias("hash")), number)
        plan = bottom._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == shuffles
        # in the printed tree what runs first stands last
        assert plan.rindex("WindowGroupLimit" if number == 7 else "part") > plan.rindex("Exchange hashpartitioning")


def test_no_spans_and_no_budget(spark, spans):
    assert budget.sample_spans(spans.limit(0), 3).count() == 0
    with pytest.raises(ValueError):
        budget.sample_traces(spans, 0)
