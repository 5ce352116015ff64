"""Every message ends in one place: stored, waiting or dead."""

import time

import pytest
from pyspark.sql import functions as F

from spanloom.sources import files
from spanloom.streaming import ingest, retry

SCHEDULE = retry.Schedule(attempts=3, first_delay=60, longest=600, slot=10)


class Place:
    """A folder sink that fails as told, with a clock of its own."""

    def __init__(self, spark, tmp_path):
        self.spark, self.out, self.now, self.fails = spark, str(tmp_path), 1000.0, False
        self.sink = retry.retrying_sink(
            self.store, f"{self.out}/retry", SCHEDULE, self.undo, lambda: self.now)

    def store(self, batch, batch_id):
        rows = batch.filter("body != 'poison'") if self.fails == "row" else batch
        rows.write.mode("overwrite").parquet(f"{self.out}/stored/batch={batch_id}")
        if self.fails == "row":
            return batch.filter("body = 'poison'")
        if self.fails:
            raise OSError("disk is away")

    def undo(self, spark, batch_id):
        files.remove(spark, f"{self.out}/stored/batch={batch_id}")

    def run(self, batch_id, *bodies):
        self.sink(self.spark.createDataFrame([(b,) for b in bodies], "body string"), batch_id)

    def _bodies(self, frame):
        return sorted((r["body"], r["attempt"]) for r in frame.collect()) if frame is not None else []

    @property
    def stored(self):
        paths = files.matching(self.spark, f"{self.out}/stored/batch=*")
        return self._bodies(self.spark.read.parquet(*paths)) if paths else []

    @property
    def waiting(self):
        return self._bodies(retry.waiting_messages(self.spark, f"{self.out}/retry"))

    @property
    def dead(self):
        return self._bodies(retry.dead_messages(self.spark, f"{self.out}/retry"))


@pytest.fixture
def place(spark, tmp_path):
    return Place(spark, tmp_path)


def test_waits_twice_as_long_then_is_stored(place):
    assert (place.stored, place.waiting, place.dead) == ([], [], [])
    place.fails = True
    place.run(0, "a", "b")
    assert place.stored == [] and place.waiting == [("a", 1), ("b", 1)]
    place.fails = False
    place.now += 59
    place.run(1, "c")  # not due yet
    assert place.stored == [("c", 0)] and place.waiting == [("a", 1), ("b", 1)]
    place.fails = True
    place.now += 12
    place.run(2, "d")
    assert place.waiting == [("a", 2), ("b", 2), ("d", 1)]
    place.fails = False
    place.now += 75
    place.run(3)  # one failure: due after 60 seconds, two: after 120
    assert place.stored == [("c", 0), ("d", 1)] and place.waiting == [("a", 2), ("b", 2)]
    place.now += 60
    place.run(4, "e")
    assert place.stored == [("a", 2), ("b", 2), ("c", 0), ("d", 1), ("e", 0)] and place.waiting == place.dead == []


def test_dead_after_the_last_attempt(place):
    place.fails = True
    for batch_id in range(3):
        place.run(batch_id, *(["a"] if batch_id == 0 else []))
        place.now += 1000
    assert place.dead == [("a", 3)] and place.stored == place.waiting == []
    error = retry.dead_messages(place.spark, f"{place.out}/retry").first()["error"]
    assert error == "OSError: disk is away"
    place.fails = False
    place.run(3, "b")
    assert place.dead == [("a", 3)] and place.stored == [("b", 0)]


def test_rows_that_a_sink_returns(place):
    place.fails = "row"
    for batch_id, bodies in enumerate([["a", "poison"], ["b"], ["c"], ["d"]]):
        place.run(batch_id, *bodies)
        place.now += 1000
    assert place.stored == [("a", 0), ("b", 0), ("c", 0), ("d", 0)] and place.dead == [("poison", 3)]


def test_repeated_batches_leave_no_copy(place, monkeypatch):
    place.fails = True
    place.run(0, "a")
    place.run(0, "a")  # finished: nothing happens
    assert place.waiting == [("a", 1)]
    place.now += 100
    # dies after it has set its messages aside
    finish = retry._set_aside
    monkeypatch.setattr(retry, "_set_aside", lambda *a: (finish(*a), 1 / 0))
    with pytest.raises(ZeroDivisionError):
        place.run(1, "b")
    monkeypatch.setattr(retry, "_set_aside", finish)
    # the repetition takes the same messages, much later, and stores them
    place.now += 10_000
    place.fails = False
    place.run(1, "b")
    assert place.stored == [("a", 1), ("b", 0)] and place.waiting == []
    place.now += 10_000
    place.run(2, "c")
    assert place.stored == [("a", 1), ("b", 0), ("c", 0)] and place.waiting == place.dead == []


def test_clock_that_goes_back(place):
    place.fails = True
    place.run(0, "a")
    place.now -= 500
    place.run(1, "b")
    assert place.waiting == [("a", 1), ("b", 1)]
    place.fails = False
    place.now += 1000
    place.run(2)
    assert place.stored == [("a", 1), ("b", 1)] and place.waiting == []


def test_folders_do_not_pile_up(place):
    for batch_id in range(8):
        place.fails = batch_id % 2 == 0
        place.run(batch_id, f"m{batch_id}")
        place.now += 100
    assert place.stored == sorted((f"m{i}", (i + 1) % 2) for i in range(8))
    folder = f"{place.out}/retry"
    left = [len(files.matching(place.spark, f"{folder}/{t}/batch=*")) for t in ("waiting", "rounds", "finished")]
    assert max(left) <= 2


def test_a_stream_without_messages_goes_on(spark, tmp_path):
    """With a pulse what waits is stored though no message comes."""
    place = Place(spark, tmp_path)
    spark.createDataFrame([("a",)], "body string").write.parquet(f"{tmp_path}/in")
    tries = []

    def store(batch, batch_id):
        rows = [r["body"] for r in batch.collect()]
        tries.append(rows)
        if rows and sum(map(len, tries)) < 3:
            raise OSError

    sink = retry.retrying_sink(store, f"{place.out}/retry", retry.Schedule(first_delay=1, slot=1))
    messages = spark.readStream.schema("body string").parquet(f"{tmp_path}/in")
    running = ingest.run(retry.with_pulse(messages), sink, f"{tmp_path}/checkpoint")
    try:
        end = time.time() + 90
        while sum(map(len, tries)) < 3 and time.time() < end and running.isActive:
            time.sleep(0.2)
    finally:
        running.stop()
    assert [t for t in tries if t] == [["a"]] * 3 and retry.dead_messages(spark, f"{place.out}/retry") is None
