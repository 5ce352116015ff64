"""Calls paired from events with keyed state and timers.

Calls are dealt into shards.  Each call holds its first time and its last event, not its events.  A call whose last event is an answer is
shown at once; one without an answer is shown as unfinished when ``timeout`` has passed without an event, and
again when the answer comes after all.  State goes ``keep`` after a call's newest event.  An event that comes
later still, for which nothing is held any more, is passed on as it is.

Every row tells all that is known of a call, or one late event, in the form of ``calls.event_parts``:
``calls.merge_parts`` over the rows of a call gives what a table of all its events would give.

Handing Python a row takes longer than what is done with it, so events reach the state as lists in a text, and rows leave
it so.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from itertools import islice
from operator import itemgetter

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from spanloom import session
from spanloom.operators import calls
from spanloom.operators.calls import CALL_COLUMNS

FINISHED, UNFINISHED, LATE = "finished", "unfinished", "late"

#: Calls are held in so many shards; the open calls of one are read and written together.
SHARDS = 1024

_CALL_FIELDS = ", ".join(f"{c} string" for c in CALL_COLUMNS)
_PARTS = (
    f"{_CALL_FIELDS}, state string, revision int, timestamp long, "
    "last struct<attempt_no:bigint,phase:int,timestamp:bigint,status:int>"
)
_PART = Row(*CALL_COLUMNS, "state", "revision", "timestamp", "last")
_LAST = Row("attempt_no", "phase", "timestamp", "status")

_call_of, _said_by = itemgetter(*CALL_COLUMNS), itemgetter(*_LAST)

#: A text holds so many rows at most.
_TEXT_ROWS = 1000
_TEXT = Row("rows")


class Calls(StatefulProcessor):
    """The calls of a shard: what the events of each so far say, and when to stop waiting for it.

    Asking the state store for one call at a time takes longer than all the rest, so a shard's open calls are one
    text, and one timer stands for the first of them that is due.
    """

    def __init__(self, timeout_ms: int, keep_ms: int):
        self.timeout_ms, self.keep_ms = timeout_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("calls", "open string")

    def close(self) -> None:
        pass

    @staticmethod
    def _row(call: tuple, state: str, revision: int, first: int, last: tuple) -> Row:
        return _PART(*call, state, revision, first, _LAST(*last))

    @staticmethod
    def _due(newest: int, wait_ms: int) -> int:
        return -(-newest // 1000) + wait_ms

    def _open(self) -> dict[tuple, tuple]:
        """``(first, newest, revision, waits, last)`` of each open call."""
        held = self.held.get()
        return {tuple(call): (*facts, tuple(last)) for call, facts, last in json.loads(held[0])} if held else {}

    def _first_due(self, calls_held: dict[tuple, tuple]) -> int | None:
        """When the first call has to be looked at: both waits follow its newest event."""
        return min(
            (self._due(newest, self.timeout_ms if waits else self.keep_ms)
             for _, newest, _, waits, _ in calls_held.values()),
            default=None,
        )

    def _keep(self, calls_held: dict[tuple, tuple], before: int | None) -> None:
        """Hold these calls from now on; ``before`` is the timer that stands."""
        if calls_held:
            self.held.update((json.dumps([(call, facts, last) for call, (*facts, last) in calls_held.items()]),))
        else:
            self.held.clear()
        due = self._first_due(calls_held)
        if due != before:
            if before is not None:
                self.handle.deleteTimer(before)
            if due is not None:
                self.handle.registerTimer(due)

    def _events(self, rows) -> Iterator[tuple[tuple, tuple]]:
        """The call of each event, and what it says, in the order of ``last``."""
        return ((_call_of(row), _said_by(row)) for row in rows)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        held = self._open()
        before = self._first_due(held)
        watermark = timerValues.getCurrentWatermarkInMs()
        now: dict[tuple, tuple] = {}
        for call, said in self._events(rows):
            at = said[2]
            known = now.get(call) or held.get(call)
            # an event without a time cannot be waited for
            if at is None or (call not in held and self._due(at, self.keep_ms) <= watermark):
                yield self._row(call, LATE, 0, at, said)
                if known:
                    now[call] = known
            elif known:
                first, newest, revision, waits, last = known
                now[call] = (
                    min(first, at), max(newest, at), revision, waits or at > newest,
                    said if _follows(said, last) else last,
                )
            else:
                now[call] = (at, at, 0, True, said)
        if not now:
            return
        for call, (first, newest, revision, waits, last) in now.items():
            if last[1] == 1:
                revision += 1
                yield self._row(call, FINISHED, revision, first, last)
            held[call] = (first, newest, revision, waits, last)
        self._keep(held, before)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        held = self._open()
        expired = expiredTimerInfo.getExpiryTimeInMs()
        passed = max(expired, timerValues.getCurrentWatermarkInMs() - 1)
        left: dict[tuple, tuple] = {}
        for call, (first, newest, revision, waits, last) in held.items():
            if waits and self._due(newest, self.timeout_ms) <= passed:
                waits = False
                if last[1] == 0:
                    revision += 1
                    yield self._row(call, UNFINISHED, revision, first, last)
            if self._due(newest, self.keep_ms) > passed:
                left[call] = (first, newest, revision, waits, last)
        # the timer that went off stands no more
        self._keep(left, None)


class ListedCalls(Calls):
    """``Calls`` for rows that hold a list of events each; what is said of calls are lists of rows."""

    def _events(self, rows) -> Iterator[tuple[tuple, tuple]]:
        return ((tuple(call), tuple(said)) for row in rows for call, *said in json.loads(row["events"]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        return _listed(super().handleInputRows(key, rows, timerValues))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        return _listed(super().handleExpiredTimer(key, timerValues, expiredTimerInfo))


def _listed(rows: Iterable[Row]) -> Iterator[Row]:
    """Rows without names, as many to a text as it holds; the fields of the last event come last."""
    left = iter(rows)
    while some := list(islice(left, _TEXT_ROWS)):
        yield _TEXT(json.dumps([(*row[:-1], *row[-1]) for row in some]))


def _unlisted(texts: DataFrame) -> DataFrame:
    """The rows of ``_listed``."""
    rows = texts.select(F.explode(F.from_json("rows", "array<array<string>>", {"mode": "FAILFAST"})).alias("row"))
    names = [*CALL_COLUMNS, "state", "revision", "timestamp"]
    plain = [F.col("row")[i].alias(name) for i, name in enumerate(names)]
    last = F.struct(*[F.col("row")[len(names) + i].alias(name) for i, name in enumerate(_LAST)])
    kinds = dict(re.findall(r"(\w+) ((?:struct<.*>)|\w+)", _PARTS))
    return rows.select(*plain, last.alias("last")).select(*[F.col(c).cast(kind).alias(c) for c, kind in kinds.items()])


def _event_text() -> Column:
    """An event as a JSON list: its call, then what it says."""
    said = [F.coalesce(F.col(f"event.{c}").cast("string"), F.lit("null")) for c in _LAST]
    return F.concat(F.lit("["), F.concat_ws(",", F.to_json(F.array(*CALL_COLUMNS)), *said), F.lit("]"))


def _lists(batches):
    """A row per shard of each batch, with a JSON list of its events."""
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        table = pa.Table.from_batches([batch]).group_by("shard").aggregate([("event", "list")])
        joined = pc.binary_join(table["event_list"].combine_chunks(), ",")
        lists = pc.binary_join_element_wise("[", joined, "]", "")
        yield pa.RecordBatch.from_arrays([table["shard"].combine_chunks(), lists], ["shard", "events"])


def _follows(event: tuple, last: tuple) -> bool:
    """Whether an event comes behind the last one so far."""
    try:
        return event > last
    except TypeError:  # one of them lacks what the other one has
        return _rank(event) > _rank(last)


def _rank(event: tuple) -> tuple:
    """The order of ``max`` over event structs: nulls first."""
    return tuple((v is not None, v) for v in event)


def pair_calls(
    events: DataFrame, delay: str = "10 minutes", timeout_ms: int = 60_000, keep_ms: int = 86_400_000,
    shards: int = SHARDS,
) -> DataFrame:
    """Rows of calls as they finish, are given up or are completed after all.

    ``delay`` is how far events of different calls may be out of order.  The watermark moves the timers
    only: no event is dropped for coming late.  Of a call whose events fill a micro-batch, one event is
    held at a time.  A micro-batch reads and writes the open calls of the ``shards`` it touches; raise
    their number with that of open calls, and keep it as long as the checkpoint.
    """
    if keep_ms <= timeout_ms:
        raise ValueError("state has to be kept for longer than the timeout")
    timed = events.withColumn("event_time", F.timestamp_micros(F.col("event.timestamp")))
    shard = F.pmod(F.xxhash64(*CALL_COLUMNS), F.lit(shards)).cast("int").alias("shard")
    dealt = timed.withWatermark("event_time", delay).select(shard, _event_text().alias("event"))
    return _unlisted(dealt.mapInArrow(_lists, "shard int, events string").groupBy("shard").transformWithState(
        ListedCalls(timeout_ms, keep_ms), "rows string", "append", "eventTime"
    ))


def stream_calls(
    events: DataFrame, path: str, checkpoint: str, available_now: bool = False, **settings
) -> StreamingQuery:
    """Append the rows of ``pair_calls`` to a table; each micro-batch is committed once."""
    spark = events.sparkSession
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    # timers and several kinds of state need the store on disk; the query keeps what it started with
    spark.conf.set(name, session.CLUSTER_SETTINGS[name])
    try:
        writer = pair_calls(events, **settings).writeStream.format("parquet").outputMode("append").option(
            "checkpointLocation", checkpoint
        )
        return (writer.trigger(availableNow=True) if available_now else writer).start(path)
    finally:
        spark.conf.set(name, before)


def paired(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_PARTS).parquet(path)


def call_spans(spark: SparkSession, path: str) -> DataFrame:
    """A client span per call from all that was said of it, unfinished calls included."""
    return calls.part_spans(calls.merge_parts(paired(spark, path)))


def late_events(spark: SparkSession, path: str) -> DataFrame:
    """Events that came after their call's state had gone; ``call_spans`` counts them."""
    return paired(spark, path).filter(F.col("state") == LATE)
