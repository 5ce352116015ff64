"""Messages that could not be stored, tried again when they are due, and at last put aside for good.

A sink that raises stops the stream until somebody restarts it.  ``retrying_sink`` goes on instead: what a
micro-batch could not store waits under its due time and joins the first micro-batch after that; each failure
doubles the wait, and after so many attempts a message goes to the ``dead`` table with its error.

A due time is a *slot* of some seconds.  Each micro-batch takes the slots after the one its predecessor took last, up
to now, and what it sets aside lies in later slots.  So waiting messages are written once an attempt and never
rewritten, and which are taken is one number per micro-batch, stored before anything is read.  A micro-batch that is
repeated takes the same messages again and replaces what its first try left: each message is in one place.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.sources import files
from spanloom.streaming import ingest

#: Attempts a message has behind it; a column of what the sink is handed.
ATTEMPT = "attempt"
ERROR_CHARACTERS = 1000

_ROUND = "since long, upto long"
_BEFORE_ALL = -1

#: Stores a micro-batch; may return the rows it could not store, with all their columns, or raise for all.
Store = Callable[[DataFrame, int], DataFrame | None]


@dataclass(frozen=True)
class Schedule:
    """When to try again: seconds after the first failure, doubled up to ``longest``; ``attempts`` in all."""

    attempts: int = 5
    first_delay: int = 60
    longest: int = 3600
    slot: int = 10

    def slot_of(self, seconds: float) -> int:
        return int(seconds // self.slot)

    def due(self, now: float, failures: Column) -> Column:
        """The slot of a message that has failed so many times; never one that has begun."""
        wait = F.least(F.lit(float(self.longest)), self.first_delay * F.pow(F.lit(2.0), failures - 1))
        return (F.floor((F.lit(float(now)) + wait) / self.slot) + 1).cast("bigint")


def forget_batch(out: str) -> Callable[[SparkSession, int], None]:
    """Takes back what ``ingest.write_outcomes`` has written of a micro-batch; outcomes, which show it, go first."""

    def undo(spark: SparkSession, batch_id: int) -> None:
        for table in ("outcomes", "spans", "quarantine"):
            files.remove(spark, f"{out}/{table}/batch={batch_id}")

    return undo


def retrying_sink(
    store: Store, out: str, schedule: Schedule = Schedule(),
    undo: Callable[[SparkSession, int], None] | None = None, clock: Callable[[], float] = time.time,
) -> ingest.Sink:
    """A sink that hands micro-batches and due messages to ``store`` and keeps what fails under ``out``.

    ``store`` must replace its own output when a micro-batch is repeated, and show none of one that raised, or
    ``undo`` has to take it back.  Without new messages no micro-batch runs: see ``with_pulse``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if files.exists(spark, f"{out}/finished/batch={batch_id}/_SUCCESS"):
            return
        now = clock()
        since, upto = _round(spark, out, batch_id, schedule.slot_of(now))
        _remove_taken(spark, out, batch_id, since)
        fresh = batch.withColumn(ATTEMPT, F.lit(0))
        tried = fresh.unionByName(_waiting(spark, out, fresh, since, upto, batch_id))
        error = "rejected by the sink"
        try:
            failed = store(tried, batch_id)
        except Exception as raised:  # whatever stops a sink: the messages wait, and the error stays with them
            if undo:
                undo(spark, batch_id)
            failed, error = tried, f"{type(raised).__name__}: {raised}"[:ERROR_CHARACTERS]
        if failed is not None:
            # of a clock that was put back, still behind what is taken
            _set_aside(failed, out, batch_id, max(now, upto * schedule.slot), schedule, error)
        spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{out}/finished/batch={batch_id}")

    return write


def _numbers(spark: SparkSession, pattern: str) -> list[int]:
    return [int(re.search(r"batch=(\d+)", p)[1]) for p in files.matching(spark, pattern)]


def _round(spark: SparkSession, out: str, batch_id: int, slot: int) -> tuple[int, int]:
    """The slots (after, up to) that a micro-batch takes; what a first try has settled stays."""
    done = [n for n in _numbers(spark, f"{out}/rounds/batch=*/_SUCCESS") if n <= batch_id]
    latest = max(done, default=None)
    settled = spark.read.schema(_ROUND).parquet(f"{out}/rounds/batch={latest}").first() if done else None
    if settled and latest == batch_id:
        return settled["since"], settled["upto"]
    since = settled["upto"] if settled else _BEFORE_ALL
    upto = max(since, slot)
    spark.range(1).select(F.lit(since).cast("long").alias("since"), F.lit(upto).cast("long").alias("upto")).coalesce(
        1
    ).write.mode("overwrite").parquet(f"{out}/rounds/batch={batch_id}")
    return since, upto


def _slots(spark: SparkSession, out: str) -> list[tuple[int, int, str]]:
    """Batch, slot and path of each folder of waiting messages."""
    found = files.matching(spark, f"{out}/waiting/batch=*/slot=*")
    return [(*map(int, re.search(r"batch=(\d+)/slot=(\d+)", p).groups()), p) for p in found]


def _waiting(
    spark: SparkSession, out: str, like: DataFrame, since: int, upto: int, below: int
) -> DataFrame:
    paths = [p for batch, slot, p in _slots(spark, out) if batch < below and since < slot <= upto]
    if not paths:
        return like.limit(0)
    return spark.read.schema(like.schema).parquet(*paths)


def _set_aside(
    failed: DataFrame, out: str, batch_id: int, now: float, schedule: Schedule, error: str
) -> None:
    counted = failed.withColumn(ATTEMPT, F.col(ATTEMPT) + 1)
    last = F.col(ATTEMPT) >= schedule.attempts
    dead = counted.filter(last)
    if not dead.isEmpty():
        dead.withColumn("error", F.lit(error)).write.mode("overwrite").parquet(f"{out}/dead/batch={batch_id}")
    counted.filter(~last).withColumn("slot", schedule.due(now, F.col(ATTEMPT))).write.mode("overwrite").partitionBy(
        "slot"
    ).parquet(f"{out}/waiting/batch={batch_id}")


def _remove_taken(spark: SparkSession, out: str, batch_id: int, since: int) -> None:
    """What finished micro-batches have taken, and what a first try of this one has set aside."""
    for path in (f"{out}/waiting/batch={batch_id}", f"{out}/dead/batch={batch_id}"):
        files.remove(spark, path)
    held = set()
    for batch, slot, path in _slots(spark, out):
        if slot <= since:
            files.remove(spark, path)
        else:
            held.add(batch)
    for batch in _numbers(spark, f"{out}/waiting/batch=*"):
        if batch not in held:
            files.remove(spark, f"{out}/waiting/batch={batch}")
    for table in ("rounds", "finished"):
        for batch in _numbers(spark, f"{out}/{table}/batch=*"):
            if batch < batch_id - 1:
                files.remove(spark, f"{out}/{table}/batch={batch}")


def waiting_messages(spark: SparkSession, out: str) -> DataFrame | None:
    """Messages that wait, with their ``slot`` and attempts; None where there are none."""
    done = [n for n in _numbers(spark, f"{out}/rounds/batch=*/_SUCCESS")]
    if not done:
        return None
    upto = spark.read.schema(_ROUND).parquet(f"{out}/rounds/batch={max(done)}").first()["upto"]
    paths = [p for _, slot, p in _slots(spark, out) if slot > upto]
    return spark.read.option("basePath", f"{out}/waiting").parquet(*paths).drop("batch") if paths else None


def dead_messages(spark: SparkSession, out: str) -> DataFrame | None:
    """Messages that failed for good, with the last ``error``; None before the first one."""
    paths = files.matching(spark, f"{out}/dead/batch=*/_SUCCESS")
    return spark.read.parquet(*[p.rsplit("/", 1)[0] for p in paths]) if paths else None


def with_pulse(routed: DataFrame) -> DataFrame:
    """The stream with a source beside it that adds no row but lets micro-batches run while no message comes."""
    beat = routed.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
    none = beat.filter(F.col("value") < 0)
    return routed.unionByName(none.select(*[
        F.lit(None).cast(f.dataType).alias(f.name) for f in routed.schema.fields
    ]))
