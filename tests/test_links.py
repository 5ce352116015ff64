"""Links to the nearest ancestor of another service, against a walk over each trace."""

import random
from collections import Counter

import pytest

from spanloom import schema
from spanloom.operators import links

WINDOW = dict(end_ts=1900, lookback=700)
INCOMING, OUTGOING = ("SERVER", "CONSUMER"), ("CLIENT", "PRODUCER")


def span(trace, number, parent, kind, service, remote=None, timestamp=1_500_000, tags=None):
    return {
        "trace_id": f"{trace:032x}", "id": f"{number:016x}", "parent_id": f"{parent:016x}" if parent else None,
        "kind": kind, "timestamp": timestamp, "local_service": service, "remote_service": remote, "tags": tags or {},
        "annotations": [],
    }


def frame(spark, rows):
    return spark.createDataFrame([tuple(r.get(f) for f in schema.SPAN_FIELDS) for r in rows], schema.SPAN)


def found(spark, rows):
    made = links.service_links(frame(spark, rows), **WINDOW).collect()
    return {(r.parent, r.child): (r.call_count, r.error_count) for r in made}


def brute(rows):
    ends = {}
    for r in sorted(rows, key=lambda r: tuple((r[c] is not None, r[c] or "") for c in ("local_service", "remote_service", "parent_id", "kind"))):
        ends.setdefault((r["trace_id"], r["id"], r["kind"] in INCOMING), r)

    def up(key):
        trace, number, incoming = key
        if incoming and (trace, number, False) in ends:
            return trace, number, False
        parent = ends[key]["parent_id"]
        return next((k for k in ((trace, parent, True), (trace, parent, False)) if k in ends), None)

    above = {key: up(key) for key in ends}
    used = set(above.values())
    calls, errors = Counter(), Counter()
    for key, r in ends.items():
        seen, at, own = {key}, above[key], r["local_service"]
        while at not in seen and at is not None and ends[at]["local_service"] in (None, own):
            seen.add(at)
            at = above[at]
        caller = ends[at]["local_service"] if at is not None and at not in seen else None
        if r["timestamp"] is None or not 1_200_000 <= r["timestamp"] <= 1_900_000:
            continue
        edge = (None, None)
        if r["kind"] in INCOMING and own:
            edge = (caller or r["remote_service"], own)
        elif r["kind"] in OUTGOING and key not in used and r["remote_service"]:
            edge = (own or caller, r["remote_service"])
        if None not in edge and edge[0] != edge[1]:
            calls[edge] += 1
            errors[edge] += "error" in r["tags"]
    return {e: (n, errors[e]) for e, n in calls.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_links_against_a_walk(spark, seed):
    rng = random.Random(seed)
    rows = []
    for trace in range(1, 60):
        size = rng.choice([1, 3, 8, 25])
        for number in range(1, size + 1):
            # parents before, behind (circles) and outside of the trace
            parent = rng.choice([number - 1, number - 1, rng.randint(0, size), 99])
            kinds = rng.choice([["CLIENT"], ["SERVER"], ["CONSUMER"], ["PRODUCER"], [None], [None], ["CLIENT", "SERVER"]])
            for kind in kinds:
                rows.append(span(
                    trace, number, parent, kind, rng.choice(["web", "api", "db", None, None]), rng.choice(["api", "db", None]),
                    rng.choice([None, 1_100_000, 1_500_000, 1_600_000]), rng.choice([{}, {"error": "x"}]),
                ))
    assert found(spark, rows) == brute(rows)


def test_deep_chain_and_circles(spark):
    deep = [span(1, 1, 0, "SERVER", "web"), *(span(1, n, n - 1, None, None if n % 3 else "api") for n in range(2, 1000))]
    deep.append(span(1, 1000, 999, "SERVER", "api"))
    circle = [span(2, 1, 2, "SERVER", "a"), span(2, 2, 1, None, None)]
    own = [span(3, 1, 1, "SERVER", "b", "edge")]
    assert found(spark, [*deep, *circle, *own]) == {("web", "api"): (1, 0), ("edge", "b"): (1, 0)}


def test_lost_parents_and_copies(spark):
    rows = [
        span(1, 1, 0, "SERVER", "web"), span(1, 2, 1, "CLIENT", "web", "api"),
        span(1, 2, 1, "SERVER", "api", tags={"error": "x"}), span(1, 2, 1, "SERVER", "api", tags={"error": "x"}),
        span(1, 3, 2, None, None), span(1, 4, 3, "CLIENT", None, "db"),
        span(2, 7, 6, "SERVER", "api", "web"), span(2, 8, 6, "SERVER", "db"),
        span(3, 1, 0, "CLIENT", "web", "old", timestamp=1),
    ]
    assert found(spark, rows) == {("web", "api"): (2, 1), ("api", "db"): (1, 0)}
    assert found(spark, []) == {}
