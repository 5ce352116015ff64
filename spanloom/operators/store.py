"""Trace-store questions over a table of spans.

Spans must be unique per (trace, ID, kind): store the output of ``dedup_spans``, best by ``write_spans``.
The questions work on any table of spans; where it has the columns of that layout, folders of other
times and files of other traces are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom import schema, session
from spanloom.functions import headers
from spanloom.operators.dedup import SPAN_KEY, dedup_spans, keep_first
from spanloom.operators.joins import left_join_summary

MAX_BROADCAST_TRACES = 10_000

# Columns of the layout: the low 64 bits of the trace, and what the folders are named by: the first day
# of the period a span falls into, null without a timestamp.
TRACE_LOW = "trace_low"
PERIODS = ("day", "month", "year")
TRACE_LOW_DIGITS = 16


def _first_day(period: str, micros: Column) -> Column:
    return F.to_date(F.date_trunc(period, F.timestamp_micros(micros)))


def _trace_low(trace_id: Column) -> Column:
    return F.substring(trace_id, -TRACE_LOW_DIGITS, TRACE_LOW_DIGITS)


def lay_out(spans: DataFrame, period: str = "day") -> DataFrame:
    """Spans with the columns of the layout in front of whatever else they have."""
    if period not in PERIODS:
        raise ValueError(f"period must be one of {PERIODS}")
    return spans.withColumns({
        TRACE_LOW: _trace_low(F.col("trace_id")), period: _first_day(period, F.col("timestamp")),
    })


def write_spans(
    spans: DataFrame, path: str, period: str = "day", files: int | None = None, more: tuple[str, ...] = ()
) -> None:
    """A folder per period, in it files of neighbouring traces, sorted.

    Choose the period by what it holds: a folder should fill some files.  The ranges go down to the
    span, so a trace with a third of all spans is spread as well.  ``files`` is the number of ranges,
    as many as the session shuffles into by default; ``more`` names further columns to keep.
    """
    laid_out = lay_out(spans.select(*schema.SPAN_FIELDS, *more), period)
    order = [period, TRACE_LOW, "trace_id", "id"]
    ranged = laid_out.repartitionByRange(files, *order) if files else laid_out.repartitionByRange(*order)
    _write(ranged.sortWithinPartitions(*order), path, period)


def write_unique_spans(spans: DataFrame, path: str, period: str = "year") -> None:
    """``write_spans`` of ``dedup_spans``, moving every span once instead of twice.

    Copies of a span have the same trace and ID and so fall into the same range, where the first one stays; ranges do
    not depend on the period, as copies may differ in theirs.  A range has a file in each period that it
    touches, so this is for a store of few periods; all copies of one span are in one range.
    """
    unique = unique_in_ranges(lay_out(spans.select(*schema.SPAN_FIELDS), period))
    ordered = unique.sortWithinPartitions(period, TRACE_LOW, "trace_id", "id")
    _write(ordered, path, period)


def _write(ordered: DataFrame, path: str, period: str) -> None:
    """Zstandard, as IDs and tags repeat much."""
    with session.dropping_shuffles(ordered.sparkSession):
        ordered.write.mode("overwrite").option("compression", "zstd").partitionBy(period).parquet(path)


def unique_in_ranges(laid_out: DataFrame) -> DataFrame:
    """``dedup_spans`` in ranges of traces: copies are in one range, so nothing moves a second time."""
    ranged = laid_out.repartitionByRange(TRACE_LOW, "trace_id", "id")
    return dedup_spans(ranged, [TRACE_LOW, *SPAN_KEY])


def read_spans(
    spark: SparkSession, path: str, period: str = "day", only: list[str] | None = None
) -> DataFrame:
    """The stored spans, or those of some files ``only``."""
    read = spark.read.schema(f"{schema.SPAN}, {TRACE_LOW} string, {period} date").option("basePath", path)
    return read.parquet(*(only or [path]))


def between(spans: DataFrame, start: int | None, end: int | None, undated: bool) -> DataFrame:
    """Spans of a time in microseconds, both ends included; ``undated`` keeps those without one."""

    def within(value: Column, low: Column, high: Column) -> Column:
        inside = F.lit(True)
        if start is not None:
            inside = inside & (value >= low)
        if end is not None:
            inside = inside & (value <= high)
        return value.isNull() | inside if undated else value.isNotNull() & inside

    low, high = F.lit(start).cast("bigint"), F.lit(end).cast("bigint")
    found = spans.filter(within(F.col("timestamp"), low, high))
    for period in PERIODS:
        if period in spans.columns:
            bounds = _first_day(period, low), _first_day(period, high)
            found = found.filter(within(F.col(period), *bounds))
    return found


def plain(spans: DataFrame) -> DataFrame:
    """Without the columns of the layout."""
    return spans.drop(TRACE_LOW, *PERIODS)


def matches(
    service: str | None, span_name: str | None, tags: dict[str, str | None] | None,
    min_duration: int | None, max_duration: int | None,
) -> Column:
    """All conditions on one span; a tag condition without a value asks for the key only."""
    wanted = [F.lit(True)]
    if service is not None:
        wanted.append(F.col("local_service") == service)
    if span_name is not None:
        wanted.append(F.col("name") == span_name)
    for key, value in (tags or {}).items():
        found = F.col("tags")[key]
        wanted.append(found.isNotNull() if value is None else found == value)
    if min_duration is not None:
        wanted.append(F.col("duration") >= min_duration)
    if max_duration is not None:
        wanted.append(F.col("duration") <= max_duration)
    return reduce(Column.__and__, wanted)


def find_traces(
    spans: DataFrame, end_ts: int, lookback: int, service: str | None = None,
    span_name: str | None = None, tags: dict[str, str | None] | None = None,
    min_duration: int | None = None, max_duration: int | None = None, limit: int = 10,
) -> DataFrame:
    """IDs and times of the latest matching traces; window in milliseconds.

    A trace matches when one of its spans meets every condition.  Its time is its earliest
    timestamp, so no span of it is older than the window and candidates are looked for in younger ones
    alone.  The conditions reach that scan; only candidates are timed.
    """
    start, end = (end_ts - lookback) * 1000, end_ts * 1000
    recent = between(spans, start, None, undated=True)
    hit = matches(service, span_name, tags, min_duration, max_duration)
    candidates = recent.filter(hit).select("trace_id").distinct()
    # what came before the window rules a trace out, so all spans of the candidates count here
    per_trace = spans.select("trace_id", "timestamp").join(
        candidates, "trace_id", "left_semi"
    ).groupBy("trace_id").agg(F.min("timestamp").alias("trace_ts"))
    return (
        per_trace.filter(F.col("trace_ts").between(start, end))
        .orderBy(F.col("trace_ts").desc(), F.col("trace_id"))
        .limit(limit)
        .select("trace_id", "trace_ts")
    )


def get_traces(spans: DataFrame, limit: int = 10, **query) -> DataFrame:
    """All spans of the latest matching traces."""
    found = find_traces(spans, limit=limit, **query).select("trace_id")
    if limit <= MAX_BROADCAST_TRACES:
        found = F.broadcast(found)
    recent = between(spans, (query["end_ts"] - query["lookback"]) * 1000, None, undated=True)
    return plain(recent.join(found, "trace_id", "left_semi"))


def get_trace(spans: DataFrame, trace_id: str, strict: bool = True) -> DataFrame:
    """Spans of one trace by time; not strict compares the low 64 bits only."""
    wanted = trace_id.lower()
    low = F.col(TRACE_LOW) if TRACE_LOW in spans.columns else _trace_low(F.col("trace_id"))
    match = low == wanted[-TRACE_LOW_DIGITS:].rjust(TRACE_LOW_DIGITS, "0")
    if strict:
        match = match & (F.col("trace_id") == wanted)
    return plain(spans.filter(match)).orderBy(F.col("timestamp").asc_nulls_first(), "id", "kind")


def get_service_names(spans: DataFrame) -> DataFrame:
    names = spans.filter(F.col("local_service").isNotNull())
    return names.select(F.col("local_service").alias("service")).distinct().orderBy("service")


def get_span_names(spans: DataFrame, service: str) -> DataFrame:
    named = spans.filter((F.col("local_service") == service) & F.col("name").isNotNull())
    return named.select("name").distinct().orderBy("name")


def get_dependencies(
    spans: DataFrame, end_ts: int, lookback: int, parent_slack: int | None = None
) -> DataFrame:
    """Calls and errors per parent and child service; window in milliseconds.

    Children are counted per parent span *before* the join, so a parent with a third of all
    children brings a handful of rows to it.  Of the other spans only parents of those children are
    ranked.  A parent may be of any time; ``parent_slack`` limits it to so many milliseconds around the
    window (or no timestamp), which spares the folders of other days.
    """
    start, end = (end_ts - lookback) * 1000, end_ts * 1000
    outgoing = F.col("kind").isin("CLIENT", "PRODUCER")
    incoming = F.col("kind").isin("SERVER", "CONSUMER")
    status = F.col("tags")["http.status_code"].try_cast("int")
    failed = F.col("tags")["error"].isNotNull() | F.coalesce(status >= 500, F.lit(False))
    children = (
        between(spans, start, end, undated=False).filter(F.col("parent_id").isNotNull())
        .select(
            "trace_id",
            F.col("parent_id").alias("id"),
            F.when(outgoing, F.col("remote_service"))
            .when(incoming, F.col("local_service")).alias("child"),
            failed.alias("failed"),
        )
        .filter(F.col("child").isNotNull())
        .groupBy("trace_id", "id", "child")
        .agg(F.count("*").alias("calls"), F.count_if("failed").alias("errors"))
    )
    # an ID shared by both ends of a call belongs to its server side
    side = F.when(incoming, F.lit(0)).otherwise(F.lit(1))
    possible = spans if parent_slack is None else between(
        spans, start - parent_slack * 1000, end + parent_slack * 1000, undated=True
    )
    parents = keep_first(
        possible.select("trace_id", "id", "kind", "local_service").join(
            children.select("trace_id", "id"), ["trace_id", "id"], "left_semi"
        ),
        ["trace_id", "id"],
        [side, F.col("kind").asc_nulls_last(), F.col("local_service").asc_nulls_last()],
    ).filter(F.col("local_service").isNotNull())
    edges = children.join(
        parents.select("trace_id", "id", F.col("local_service").alias("parent")),
        ["trace_id", "id"],
    )
    return edges.groupBy("parent", "child").agg(
        F.sum("calls").alias("call_count"), F.sum("errors").alias("error_count")
    )


def correlate_logs(logs: DataFrame, spans: DataFrame, header: str = "header") -> DataFrame:
    """Request logs with what the trace store knows about their trace.

    Adds ``trace_id`` (null for an unusable header), ``span_count``, ``first_ts`` and ``state``:
    ``traced``, ``unknown_trace`` or ``untraced``.  Spans shrink to one row per trace first, within
    each task where the store keeps traces together; the join copes with a trace ID that fills the
    logs, and logs without a usable root stay out of it.
    """
    summary = spans.groupBy("trace_id").agg(
        F.count("*").alias("span_count"), F.min("timestamp").alias("first_ts")
    )
    return correlate_with(logs, summary, header)


def _with_root(logs: DataFrame, header: str) -> DataFrame:
    parsed = headers.with_parsed(logs, F.col(header), "_parsed")
    return parsed.withColumn("trace_id", F.col("_parsed.root")).drop("_parsed")


def correlate_with(logs: DataFrame, summary: DataFrame, header: str = "header") -> DataFrame:
    """``correlate_logs`` with a row per trace made before."""
    rooted = _with_root(logs, header)
    known = F.col("trace_id").isNotNull()
    joined = left_join_summary(rooted.filter(known), summary, "trace_id").withColumn(
        "state",
        F.when(F.col("span_count").isNull(), F.lit("unknown_trace")).otherwise(F.lit("traced")),
    )
    none = F.lit(None).cast("bigint")
    untraced = rooted.filter(~known).withColumns(
        {"span_count": none, "first_ts": none, "state": F.lit("untraced")}
    )
    return joined.unionByName(untraced)


def untraced_requests(logs: DataFrame, spans: DataFrame, header: str = "header") -> DataFrame:
    """Requests whose trace is not in the store: an anti-join on trace IDs, no counts.

    Requests without a usable root stay out of the join.
    """
    rooted = _with_root(logs, header)
    # once per trace: a task sends what its neighbouring spans share once
    known = spans.select(F.col("trace_id").alias("_known")).distinct()
    missing = rooted.filter(F.col("trace_id").isNotNull()).join(
        known, F.col("trace_id") == F.col("_known"), "left_anti"
    )
    return missing.withColumn("state", F.lit("unknown_trace")).unionByName(
        rooted.filter(F.col("trace_id").isNull()).withColumn("state", F.lit("untraced"))
    )
