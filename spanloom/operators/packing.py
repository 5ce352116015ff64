"""Size-bounded messages from encoded spans.

A span takes its JSON bytes plus a separator.  With ``L`` usable list bytes, spans up to a sixteenth
of ``L`` share messages by their running size, filled to fifteen sixteenths; spans up to half of ``L``
share messages of their own; larger ones travel alone; spans that fit no message go to quarantine.  The
running sizes are two-level prefix sums, so one busy host is spread over ``buckets`` tasks instead of
being walked by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions import ids
from spanloom.functions.payload import encode_body
from spanloom.functions.wire import span_json
from spanloom.operators.dedup import SPAN_KEY, keep_first

# Default message limits.
QUEUE_MAX_BYTES = 256 * 1024
STREAM_MAX_BYTES = 1024 * 1024

DEFAULT_BUCKETS = 4096
SHARED, LARGE, ALONE, OVERSIZE = "shared", "large", "alone", "oversize"

# parts of the usable bytes that a span of each sharing class may take
SHARED_PART, LARGE_PART = 16, 2


def usable_bytes(max_bytes: int, base64: bool) -> int:
    """List bytes that are sure to fit, given that the body may have to become base64."""
    return max_bytes * 3 // 4 - 2 if base64 else max_bytes


def largest_and_step(max_bytes: int, base64: bool, part: int) -> tuple[int, int]:
    """The largest span of a sharing class, and the running bytes that make a message of it."""
    usable = usable_bytes(max_bytes, base64)
    return usable // part, usable - usable // part - 1


def partition_key(host: Column, producer: Column) -> Column:
    """The producing host; a stable stand-in per producer where the host is unknown."""
    digest = F.md5(producer.cast("binary"))
    parts = [F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.coalesce(host, F.concat_ws("-", *parts))


def encode_spans(spans: DataFrame, key: Column) -> DataFrame:
    """The columns packing needs: key, identity, JSON text and its size."""
    encoded = spans.select(
        key.alias("pack_key"), "trace_id", "id", "kind", span_json().alias("json")
    )
    return encoded.withColumn("size", (F.octet_length("json") + 1).cast("bigint"))


def pack_spans(
    encoded: DataFrame, max_bytes: int = QUEUE_MAX_BYTES, base64: bool = True,
    buckets: int = DEFAULT_BUCKETS, first_by: list[Column] | None = None, few_keys: bool = False,
) -> DataFrame:
    """Assign every encoded span to a message (``batch``) of its pack key.

    Expects one row per span; with ``first_by`` the first of differing reports in that order is packed, and as reports
    of a span are in one bucket, spans move once for both.  The order within a key is (bucket, trace ID,
    ID, kind).  Raise ``buckets`` with the data, so that a bucket of the busiest host fits a task.
    ``few_keys`` says that a row per key and bucket may be sent to all tasks; spans are then not moved to meet these rows.
    ``split`` tells messages that may have spans in several buckets.
    """
    usable = usable_bytes(max_bytes, base64)
    small, small_step = largest_and_step(max_bytes, base64, SHARED_PART)
    large, large_step = largest_and_step(max_bytes, base64, LARGE_PART)
    bucket = (ids.digest_number(F.col("trace_id"), F.col("id")) % buckets).cast("int")
    # never null, so that joins add no filter to one of the two readers of the shuffle, which share it
    dealt = encoded.withColumn("bucket", F.coalesce(bucket, F.lit(0)))
    if first_by:
        dealt = keep_first(dealt.repartition("bucket"), ["bucket", *SPAN_KEY], first_by)
    labelled = dealt.withColumn(
        "packing",
        F.when(F.col("size") + 1 > usable, F.lit(OVERSIZE))
        .when(F.col("size") > large, F.lit(ALONE))
        .when(F.col("size") > small, F.lit(LARGE))
        .otherwise(F.lit(SHARED)),
    ).filter(F.col("pack_key").isNotNull())

    # running bytes of either class; spans of another class add nothing to them
    def bytes_of(label: str) -> Column:
        return F.when(F.col("packing") == label, F.col("size")).otherwise(F.lit(0))

    classes = {SHARED: ("b", small_step), LARGE: ("l", large_step)}
    totals = labelled.groupBy("pack_key", "bucket").agg(
        *[F.sum(bytes_of(label)).alias(label) for label in classes]
    )
    before = Window.partitionBy("pack_key").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = totals.select("pack_key", "bucket", *[
        F.coalesce(F.sum(label).over(before), F.lit(0)).alias(f"{label}_before") for label in classes
    ], *[F.col(label).alias(f"{label}_bytes") for label in classes])
    inside = Window.partitionBy("pack_key", "bucket").orderBy("trace_id", "id", "kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    running = labelled.select("*", *[
        F.sum(bytes_of(label)).over(inside).alias(f"{label}_running") for label in classes
    ])
    # every key and bucket has its offsets; as a left join they are left out, sums and all, where nobody asks for a batch
    running = running.join(F.broadcast(offsets) if few_keys else offsets, ["pack_key", "bucket"], "left")
    batch = F.when(
        F.col("packing") == ALONE,
        F.concat_ws("-", F.lit("a"), "trace_id", "id", F.coalesce("kind", F.lit(""))),
    )
    split = F.lit(False)
    for label, (prefix, step) in classes.items():
        start = F.col(f"{label}_before")
        number = F.floor((start + F.col(f"{label}_running") - 1) / step)
        batch = batch.when(F.col("packing") == label, F.concat(F.lit(prefix), number.cast("string")))
        # the last message of earlier buckets, or the first that later ones may go on with
        shared = (number <= F.floor((start - 1) / step)) | (
            number >= F.floor((start + F.col(f"{label}_bytes")) / step)
        )
        split = split | ((F.col("packing") == label) & shared)
    return running.withColumns({"batch": batch, "split": split}).select(
        *encoded.columns, "packing", "batch", "bucket", "split"
    )


def oversize_spans(packed: DataFrame) -> DataFrame:
    """The spans that fit no message, for ``sinks.write_oversize``."""
    return packed.filter(F.col("packing") == OVERSIZE)


def _lists(packed: DataFrame) -> DataFrame:
    """One JSON list per message; a group holds no more than the message limit.

    Where buckets are known, a message is put together where its bucket is; only parts of split ones move.
    """
    member = F.struct("trace_id", "id", "kind", "json")
    sums = [F.count("*").alias("span_count"), F.sum("size").alias("bytes")]
    members = F.collect_list(member).alias("members")
    held = packed.filter(F.col("batch").isNotNull())
    if "split" in packed.columns:
        parts = held.groupBy("bucket", "pack_key", "batch", "split").agg(*sums, members)
        joined = parts.filter("split").groupBy("pack_key", "batch").agg(
            F.sum("span_count").alias("span_count"), F.sum("bytes").alias("bytes"),
            F.flatten(F.collect_list("members")).alias("members"),
        )
        messages = parts.filter("NOT split").select(*joined.columns).unionByName(joined)
    else:
        messages = held.groupBy("pack_key", "batch").agg(*sums, members)
    ordered = F.transform(F.sort_array("members"), lambda m: m["json"])
    return messages.select(
        "pack_key", "batch", "span_count", (F.col("bytes") + 1).alias("list_bytes"),
        F.concat(F.lit("["), F.array_join(ordered, ","), F.lit("]")).alias("list"),
    )


def queue_messages(packed: DataFrame) -> DataFrame:
    """Text messages: the list itself, or base64 when it holds anything but ASCII."""
    return _lists(packed).select(
        "pack_key", "batch", "span_count", "list_bytes", encode_body(F.col("list")).alias("body")
    )


def stream_records(packed: DataFrame) -> DataFrame:
    """Binary records with their partition key."""
    return _lists(packed).select(
        F.col("pack_key").alias("partition_key"), "batch", "span_count", "list_bytes",
        F.encode("list", "UTF-8").alias("data"),
    )
