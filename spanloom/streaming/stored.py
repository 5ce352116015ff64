"""What a stream has stored, kept in few files: merged runs and snapshots of what is live.

An ingest job writes a folder per micro-batch.  ``compact`` merges the folders of finished micro-batches
into a *run*, and runs of one level into a run of the next, so that every row is rewritten once a level
and the number of runs grows with the logarithm of the number of micro-batches.  Runs of spans have the
layout of the trace store.

A *snapshot* names the live runs; all micro-batches up to the last one they cover live in them, later
ones in their own folders.  It is one small file, written after the runs it names; a reader takes
the latest and sees each row once, whatever is merged meanwhile.  A merge that dies leaves a folder no
snapshot names, and the next one overwrites it.  ``remove_merged`` deletes what only old snapshots
need.  One job merges at a time; readers and the ingest job need no lock.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from math import ceil

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom import schema
from spanloom.operators import dedup, membership, store
from spanloom.sources import files
from spanloom.streaming import ingest

#: So many folders or runs of one level become one run.
FAN_IN = 8
FILE_BYTES = 128 * 1024 * 1024
#: What tells copies of a span apart from other spans, kept with each merged span.
CONTENT = "content"
TABLES = ("spans", "quarantine", "outcomes")
#: Of each run's spans: Bloom filters per period, and how many blocks they have.
FILTERS, BLOCKS = "filters", "blocks"
#: Micro-batches with spans of more periods than this are not pruned by a list of them.
LISTED_PERIODS = 1000

_SNAPSHOT = "level int, first long, last long, bytes long"


@dataclass(frozen=True, order=True)
class Run:
    """A merged range of micro-batches."""

    first: int
    last: int
    level: int
    bytes: int = 0

    @property
    def name(self) -> str:
        return f"from{self.first}-to{self.last}-level{self.level}"

    def path(self, out: str, table: str) -> str:
        return f"{out}/merged/{table}/run={self.name}"


@dataclass(frozen=True)
class Snapshot:
    """The live runs in order, and the finished micro-batches behind them."""

    version: int
    runs: tuple[Run, ...]
    fresh: tuple[int, ...]

    @property
    def covered(self) -> int:
        return self.runs[-1].last if self.runs else -1


def _versions(spark: SparkSession, out: str) -> list[int]:
    # a version counts once its writer has finished
    found = files.matching(spark, f"{out}/snapshots/version=*/_SUCCESS")
    return sorted(int(re.search(r"version=(\d+)/", p)[1]) for p in found)


def _runs(spark: SparkSession, out: str, version: int) -> tuple[Run, ...]:
    rows = spark.read.schema(_SNAPSHOT).parquet(f"{out}/snapshots/version={version}").collect()
    return tuple(sorted(Run(r["first"], r["last"], r["level"], r["bytes"]) for r in rows))


def snapshot(spark: SparkSession, out: str, below: int | None = None) -> Snapshot:
    """The latest state; ``below`` leaves out micro-batches from that number on.

    A micro-batch is finished when its outcomes, which are written last, are complete.
    """
    versions = _versions(spark, out)
    runs = _runs(spark, out, versions[-1]) if versions else ()
    covered = runs[-1].last if runs else -1
    done = files.matching(spark, f"{out}/outcomes/batch=*/_SUCCESS")
    numbers = sorted(int(re.search(r"batch=(\d+)/", p)[1]) for p in done)
    fresh = tuple(n for n in numbers if n > covered and (below is None or n < below))
    return Snapshot(versions[-1] if versions else -1, runs, fresh)


# ---------------------------------------------------------------- readers


def _folders(out: str, table: str, numbers: tuple[int, ...]) -> list[str]:
    return [f"{out}/{table}/batch={n}" for n in numbers]


def fresh_spans(spark: SparkSession, out: str, state: Snapshot, period: str = "day") -> DataFrame:
    """Spans of the micro-batches that no run covers yet, laid out like those of a run."""
    paths = _folders(out, "spans", state.fresh)
    read = spark.read.schema(schema.SPAN).parquet(*paths) if paths else spark.createDataFrame([], schema.SPAN)
    hashed = read.select(*schema.SPAN_FIELDS, dedup.content_hash(list(schema.SPAN_FIELDS)).alias(CONTENT))
    return store.lay_out(hashed, period)


def run_spans(spark: SparkSession, out: str, runs: tuple[Run, ...], period: str = "day") -> DataFrame:
    """Spans of some runs with the columns of the layout, ``content`` and the name of the ``run``."""
    full = f"{schema.SPAN}, {CONTENT} long, {store.TRACE_LOW} string, run string, {period} date"
    paths = [r.path(out, "spans") for r in runs]
    if not paths:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", f"{out}/merged/spans").parquet(*paths)


def read_spans(
    spark: SparkSession, out: str, period: str = "day", state: Snapshot | None = None
) -> DataFrame:
    """All stored spans as of a snapshot, the latest by default, for the questions of ``store``."""
    state = state or snapshot(spark, out)
    parts = []
    if state.runs:
        parts.append(run_spans(spark, out, state.runs, period).drop("run"))
    if state.fresh or not parts:
        parts.append(fresh_spans(spark, out, state, period))
    together = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return together.drop(CONTENT)


def read_table(
    spark: SparkSession, out: str, table: str, state: Snapshot | None = None
) -> DataFrame | None:
    """``outcomes`` or ``quarantine`` as of a snapshot; None before the first micro-batch."""
    state = state or snapshot(spark, out)
    parts = []
    if state.runs:
        read = spark.read.option("basePath", f"{out}/merged/{table}")
        parts.append(read.parquet(*[r.path(out, table) for r in state.runs]).drop("run"))
    if state.fresh:
        fresh = spark.read.option("basePath", f"{out}/{table}").parquet(*_folders(out, table, state.fresh))
        parts.append(fresh.withColumn("batch", F.col("batch").cast("long")))
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


# ---------------------------------------------------------------- merging


def _merge(
    spark: SparkSession, out: str, run: Run, parts: Snapshot, period: str, file_bytes: int
) -> Run:
    """Write the run that replaces the runs and folders of ``parts``."""
    size = 0
    for table in TABLES:
        inside = [r.path(out, table) for r in parts.runs] + _folders(out, table, parts.fresh)
        held = sum(files.total_bytes(spark, p) for p in inside)
        number = max(1, ceil(held / file_bytes))
        path = run.path(out, table)
        if table == "spans":
            spans = run_spans(spark, out, parts.runs, period).drop("run") if parts.runs else None
            if parts.fresh:
                fresh = fresh_spans(spark, out, parts, period)
                spans = fresh if spans is None else spans.unionByName(fresh)
            store.write_spans(spans, path, period, number, (CONTENT,))
        else:
            # files are put together without a shuffle
            read_table(spark, out, table, parts).coalesce(number).write.mode("overwrite").parquet(path)
        size += files.total_bytes(spark, path)
    _write_filters(spark, out, run, period, max(1, ceil(size / file_bytes / 8)))
    return Run(run.first, run.last, run.level, size)


def _write_filters(spark: SparkSession, out: str, run: Run, period: str, number: int) -> None:
    """Bloom filters over what tells the run's spans apart; only two columns are read."""
    keys = run_spans(spark, out, (run,), period).select(period, CONTENT)
    membership.sizes(keys, period).coalesce(1).write.mode("overwrite").parquet(run.path(out, BLOCKS))
    blocks = spark.read.parquet(run.path(out, BLOCKS))
    built = membership.build(keys, period, CONTENT, blocks)
    built.repartitionByRange(number, period, "block").sortWithinPartitions(period, "block").write.mode(
        "overwrite"
    ).partitionBy(period).parquet(run.path(out, FILTERS))


def _commit(spark: SparkSession, out: str, version: int, runs: list[Run]) -> None:
    rows = [(r.level, r.first, r.last, r.bytes) for r in runs]
    spark.createDataFrame(rows, _SNAPSHOT).coalesce(1).write.mode("overwrite").parquet(
        f"{out}/snapshots/version={version}"
    )


def compact(
    spark: SparkSession, out: str, period: str = "day", fan_in: int = FAN_IN, file_bytes: int = FILE_BYTES,
    below: int | None = None,
) -> Snapshot:
    """Merge what has come together: micro-batches once there are ``fan_in``, then runs of equal levels.

    All that is due is merged in one pass: runs that would only be merged on at once are not written.
    Returns the state that readers see from now on.
    """
    state = snapshot(spark, out, below)
    if len(state.fresh) < fan_in:
        return state
    kept, level = list(state.runs), 0
    taken: list[Run] = []
    while True:
        same = [r for r in kept[::-1][:fan_in - 1] if r.level == level]
        if len(same) < fan_in - 1:
            break
        # with the run that has just come together, these fill the next level
        taken = kept[-len(same):] + taken
        kept = kept[:-len(same)]
        level += 1
    first = taken[0].first if taken else state.fresh[0]
    run = Run(min(first, state.fresh[0]), state.fresh[-1], level)
    merged = _merge(spark, out, run, Snapshot(-1, tuple(taken), state.fresh), period, file_bytes)
    runs = [*kept, merged]
    _commit(spark, out, state.version + 1, runs)
    return Snapshot(state.version + 1, tuple(runs), ())


def remove_merged(spark: SparkSession, out: str, keep: int = 1) -> list[str]:
    """Delete snapshots but the last ``keep`` and what none of those reads; returns the paths.

    Call it once no reader works on an older snapshot.
    """
    versions = _versions(spark, out)
    kept = versions[-keep:]
    if not kept:
        return []
    live = [_runs(spark, out, v) for v in kept]
    tables = (*TABLES, FILTERS, BLOCKS)
    names = {r.path("", t) for runs in live for r in runs for t in tables}
    covered = min(runs[-1].last for runs in live)
    gone = [f"{out}/snapshots/version={v}" for v in versions[:-keep]]
    for table in tables:
        gone += [
            p for p in files.matching(spark, f"{out}/merged/{table}/*")
            if f"/merged/{table}/{p.rsplit('/', 1)[1]}" not in names
        ]
    for table in TABLES:
        gone += [
            p for p in files.matching(spark, f"{out}/{table}/batch=*")
            if int(p.rsplit("=", 1)[1]) <= covered
        ]
    for path in gone:
        files.remove(spark, path)
    return gone


# ---------------------------------------------------------------- duplicates


def _same(left: list[str], prefix: str) -> Column:
    return reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in left])


def unseen(
    spark: SparkSession, spans: DataFrame, out: str, state: Snapshot, period: str = "day",
    held: list[DataFrame] | None = None,
) -> DataFrame:
    """Spans that are not stored yet, one of each, however long ago the first copy came.

    Copies agree in trace, ID, kind and content, as for ``dedup``.  Spans are looked up in the Bloom
    filters of the runs, of their own periods only; what may be there is compared with the stored
    spans of those periods, and so is everything with the few micro-batches that are not merged yet.  A false
    hit costs that comparison and nothing else.  No state is kept besides the store.  What is persisted
    on the executors meanwhile is added to ``held``, for the caller to let go.
    """
    held = [] if held is None else held
    key = [*dedup.SPAN_KEY, CONTENT]
    hashed = spans.withColumn(CONTENT, dedup.content_hash(list(schema.SPAN_FIELDS)))
    unique = store.lay_out(hashed, period).dropDuplicates(key).persist(StorageLevel.MEMORY_AND_DISK)
    held.append(unique)
    stored_keys = fresh_spans(spark, out, state, period).select(*key)
    if state.runs:
        found = unique.select(period).distinct().limit(LISTED_PERIODS + 1).collect()
        periods = [r[0] for r in found]
        inside = _inside(period, periods) if len(periods) <= LISTED_PERIODS else F.lit(True)
        asked = unique.select(period, *key)
        rows, blocks = (_of_runs(spark, out, state.runs, t) for t in (FILTERS, BLOCKS))
        hits = membership.probe(
            asked, rows.filter(inside), blocks.filter(inside), period, CONTENT, ["run"]
        ).distinct().persist(StorageLevel.MEMORY_AND_DISK)
        held.append(hits)
        met = [r[0] for r in hits.select(period).distinct().limit(LISTED_PERIODS + 1).collect()]
        if met:
            inside = _inside(period, met) if len(met) <= LISTED_PERIODS else F.lit(True)
            merged = run_spans(spark, out, state.runs, period).filter(inside).select(*key)
            renamed = hits.select(*[F.col(c).alias(f"_hit_{c}") for c in key])
            stored_keys = stored_keys.unionByName(merged.join(renamed, _same(key, "_hit_"), "left_semi"))
    old = stored_keys.select(*[F.col(c).alias(f"_old_{c}") for c in key])
    return unique.join(old, _same(key, "_old_"), "left_anti").select(*spans.columns)


def _inside(period: str, values: list) -> Column:
    dated = F.col(period).isin([v for v in values if v is not None])
    return dated | F.col(period).isNull() if None in values else dated


def _of_runs(spark: SparkSession, out: str, runs: tuple[Run, ...], table: str) -> DataFrame:
    return spark.read.option("basePath", f"{out}/merged/{table}").parquet(*[r.path(out, table) for r in runs])


def compacting_sink(
    out: str, sampler: ingest.Sampler | None = None, period: str = "day", fan_in: int = FAN_IN,
    file_bytes: int = FILE_BYTES, unique: bool = False,
) -> ingest.Sink:
    """Folders like ``ingest.folder_sink``, merged between micro-batches.

    What came before is merged first and the micro-batch written then, so that the one that may be
    repeated stands in its own folder.  ``unique`` stores no span a second time.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        compact(spark, out, period, fan_in, file_bytes, below=batch_id)
        # a micro-batch that is repeated is not compared with its own first try
        before = snapshot(spark, out, below=batch_id)
        held: list[DataFrame] = []

        def keep(spans: DataFrame) -> DataFrame:
            kept = sampler(spans) if sampler else spans
            return unseen(spark, kept, out, before, period, held) if unique else kept

        try:
            ingest.write_outcomes(batch, batch_id, out, keep)
        finally:
            for frame in held:
                frame.unpersist()

    return write
