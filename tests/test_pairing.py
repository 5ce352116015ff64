"""Calls paired with keyed state and timers, over several micro-batches."""

import json

import pytest

from spanloom import session
from spanloom.operators import calls
from spanloom.streaming import pairing, state

EVENT = ", ".join(f"{c} string" for c in calls.CALL_COLUMNS) + f", event {calls._EVENT}"
SECOND = 1_000_000


@pytest.fixture
def run_dir(spark):
    return session.new_run_dir(spark, "pairing")


def event(call, at, no, phase, status=None):
    return (call, "svc", "GetRequest", "t" * 32, None, (None if at is None else at * SECOND, no, phase, status))


def deliver(spark, run_dir, arrivals, **settings):
    """Each list is a micro-batch of a run of its own; returns the rows after each."""
    seen = []
    for batch in arrivals:
        spark.createDataFrame(batch, EVENT).coalesce(1).write.mode("append").parquet(f"{run_dir}/in")
        events = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(f"{run_dir}/in")
        pairing.stream_calls(events, f"{run_dir}/out", f"{run_dir}/cp", True, **settings).awaitTermination()
        rows = pairing.paired(spark, f"{run_dir}/out").collect()
        seen.append(sorted((r.call_id, r.revision, r.state, r.timestamp // SECOND if r.timestamp else None, r.last.status) for r in rows))
    return seen


def rows(df):
    return sorted(map(str, df.collect()))


def test_a_gap_gives_an_unfinished_and_a_final_row(spark, run_dir):
    arrivals = [
        [event("a", 1, 1, 0), event("b", 2, 1, 0), event("n", None, 1, 1, 204)],
        [event("a", 3, 1, 1, 500), event("z", 1000, 1, 0)],
        [event("z", 1001, 1, 1, 200), event("b", 1002, 1, 1, 200)],
    ]
    seen = deliver(spark, run_dir, arrivals, delay="10 seconds", keep_ms=7_200_000)
    assert seen[0] == [("n", 0, "late", None, 204)]
    # the watermark has passed b's timeout, a was answered
    assert seen[1] == [("a", 1, "finished", 1, 500), ("b", 1, "unfinished", 2, None), *seen[0]]
    assert seen[2] == [
        seen[1][0], seen[1][1], ("b", 2, "finished", 2, 200), *seen[0], ("z", 1, "finished", 1000, 200)]
    everything = spark.createDataFrame([e for batch in arrivals for e in batch], EVENT)
    assert rows(pairing.call_spans(spark, f"{run_dir}/out")) == rows(state.pair_call_events(everything))
    assert pairing.late_events(spark, f"{run_dir}/out").count() == 1


def test_state_goes_and_what_comes_later_is_kept_apart(spark, run_dir):
    arrivals = [
        [event("a", 1, 1, 0)], [event("z", 5000, 1, 0)], [event("z", 5001, 1, 1, 200)],
        [event("a", 2, 1, 1, 200)], [event("y", 5002, 1, 0), event("a", 3, 2, 0)],
    ]
    seen = deliver(spark, run_dir, arrivals, delay="10 seconds", timeout_ms=60_000, keep_ms=600_000)
    assert ("a", 1, "unfinished", 1, None) in seen[1]
    assert ("a", 0, "late", 2, 200) in seen[3] and ("a", 0, "late", 3, None) in seen[4]
    everything = spark.createDataFrame([e for batch in arrivals[:4] for e in batch], EVENT)
    late = pairing.late_events(spark, f"{run_dir}/out")
    assert late.count() == 2
    # the retry that was sent last makes the call unfinished again, as in the batch
    whole = spark.createDataFrame([e for batch in arrivals for e in batch if e[0] != "y"], EVENT)
    found = pairing.call_spans(spark, f"{run_dir}/out")
    assert rows(found) == rows(state.pair_call_events(whole)) != rows(state.pair_call_events(everything))


class CountedStore:
    """A handle of the state store, with one value and its timers, that counts what it is asked."""

    def __init__(self):
        self.asked, self.value, self.timers = 0, None, set()

    def getValueState(self, name, kind):  # noqa: N802
        return self

    def get(self):
        self.asked += 1
        return self.value

    def update(self, value):
        self.asked, self.value = self.asked + 1, value

    def clear(self):
        self.asked, self.value = self.asked + 1, None

    def registerTimer(self, at):  # noqa: N802
        self.asked += 1
        self.timers.add(at)

    def deleteTimer(self, at):  # noqa: N802
        self.asked += 1
        self.timers.remove(at)


class At:
    def __init__(self, watermark, expired=None):
        self.watermark, self.expired = watermark, expired

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.watermark

    def getExpiryTimeInMs(self):  # noqa: N802
        return self.expired


def test_calls_of_a_shard_are_asked_for_at_once(spark):
    """A thousand calls take a handful of questions, and each still has its own times."""
    held = CountedStore()
    shard = pairing.Calls(60_000, 600_000)
    shard.init(held)

    def arriving(numbers, at, phase, status=None):
        return [
            dict(zip(calls.CALL_COLUMNS, (f"c{i}", "svc", "GetRequest", "t" * 32, None)),
                 timestamp=(at + i) * SECOND, attempt_no=1, phase=phase, status=status)
            for i in numbers
        ]

    assert list(shard.handleInputRows((0,), iter(arriving(range(1000), 0, 0)), At(0))) == []
    finished = list(shard.handleInputRows((0,), iter(arriving(range(500), 1, 1, 200)), At(0)))
    assert {r.call_id for r in finished} == {f"c{i}" for i in range(500)} and {r.state for r in finished} == {"finished"}
    assert held.timers == {61_000} and held.asked <= 8
    # the watermark has passed the timeout of calls up to 699, and nobody's time to be kept
    given_up = list(shard.handleExpiredTimer((0,), At(759_000), At(0, 61_000)))
    assert {(r.call_id, r.state) for r in given_up} == {(f"c{i}", "unfinished") for i in range(500, 699)}
    # the earlier ones are forgotten: kept is who had an event less than ten minutes before
    assert {call[0] for call in shard._open()} == {f"c{i}" for i in range(158, 1000)}
    assert len(held.timers - {61_000}) == 1 and held.asked <= 13


def test_settings_are_checked(spark):
    events = spark.createDataFrame([], EVENT)
    with pytest.raises(ValueError):
        pairing.pair_calls(events, timeout_ms=5, keep_ms=5)


def odd_events():
    """Texts that need care on their way, numbers that no float holds, and everything that may be absent."""
    texts = ['say "a\\b"', "line\none\ttab\u0000", "é ✓ 😀", "", "null", "[1,2]", None]
    rows = []
    for i, text in enumerate(texts):
        for no in (1, 2**60 + i):
            at = 1_700_000_000_000_000 + i * SECOND
            rows.append((f"c{i}", text, "GetRequest", "t" * 32, text, (at, no, 0, None)))
            rows.append((f"c{i}", text, "GetRequest", "t" * 32, text, (at + 2**50 % SECOND, no, 1, None if i % 2 else 404)))
    return rows


def test_texts_and_numbers_survive_the_way_through_lists(spark, run_dir):
    events = spark.createDataFrame(odd_events(), EVENT)
    events.coalesce(1).write.parquet(f"{run_dir}/in")
    arriving = spark.readStream.schema(EVENT).parquet(f"{run_dir}/in")
    pairing.stream_calls(arriving, f"{run_dir}/out", f"{run_dir}/cp", True).awaitTermination()
    merged = calls.merge_parts(pairing.paired(spark, f"{run_dir}/out"))
    assert rows(merged) == rows(calls.event_parts(events)) and merged.count() == 7


def test_python_is_handed_lists(spark):
    """A thousand events of four shards are four rows, and what is said of them is one."""
    import pyarrow as pa

    events = [[(f"c{i}", "svc", "GetRequest", "t" * 32, None), 1, 1, i * SECOND, 200] for i in range(1000)]
    batch = pa.RecordBatch.from_pydict({"shard": pa.array([i % 4 for i in range(1000)], pa.int32()),
                                        "event": [json.dumps(e) for e in events]})
    listed = [r for b in pairing._lists([batch]) for r in b.to_pylist()]
    assert len(listed) == 4
    assert sorted(e[0][0] for r in listed for e in json.loads(r["events"]) if r["shard"] == 3) == sorted(
        f"c{i}" for i in range(3, 1000, 4))
    shard = pairing.ListedCalls(60_000, 7_200_000)
    shard.init(CountedStore())
    said = list(shard.handleInputRows((0,), iter([*listed, *listed[:1]]), At(0)))
    assert len(said) == 1 and len(json.loads(said[0]["rows"])) == 1000
    made = pairing._unlisted(spark.createDataFrame(said, "rows string"))
    assert made.schema.simpleString() == spark.createDataFrame([], pairing._PARTS).schema.simpleString()
    assert made.filter("state = 'finished' AND last.status = 200 AND parent_id IS NULL").count() == 1000
