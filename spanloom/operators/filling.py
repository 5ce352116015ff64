"""Full messages from spans of any size: size classes, whose gaps smaller spans fill.

Of spans that take more than a sixteenth of a message, ``k`` fit when the largest of them would: these make up
class ``k``, 1 to 15, and travel ``k`` to a message.  What is left of such a message is a *gap*.  The gaps of
a key are laid end to end, and so are its small spans; a small span travels in the gap that its start falls
into, and what lies behind the last gap shares messages of its own.  A gap is laid down shorter than it is by the
size of a small span, so the last one that starts in it fits.  So all messages but a few per key are filled to
fifteen sixteenths as long as there are small spans, and those of class ``k`` to ``k / (k + 1)`` without.

Places are two-level prefix sums, over buckets and inside them.  A key has as many buckets as its bytes ask
for, so one with a third of all bytes is spread over tasks of bounded size, and a small key is one bucket.
Small spans meet their gaps in blocks of so many bytes, not key by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions import ids
from spanloom.operators import packing

SHARED_CLASS = packing.SHARED_PART
#: Spans of so many bytes are ordered in one task.
BUCKET_BYTES = 64 * 1024 * 1024
#: Small spans and gaps meet in blocks of so many messages; messages of a class are summed in such blocks.
BLOCK_MESSAGES = 1024

OVERSIZE = packing.OVERSIZE
_IDENTITY = ["trace_id", "id", "kind"]


def _before(*value: Column) -> list[Column]:
    """Sums over the earlier blocks of a key, or of a key and class."""
    return [F.coalesce(v, F.lit(0)) for v in value]


def room_and_small(max_bytes: int, base64: bool) -> tuple[int, int]:
    """Bytes that the spans of a message may take together, and the largest small span."""
    room = packing.usable_bytes(max_bytes, base64) - 1
    return room, room // SHARED_CLASS


def _placed(encoded: DataFrame, room: int, bucket_bytes: int) -> DataFrame:
    """Spans that fit with their ``class``, and in it their number ``nth`` and the bytes ``start`` before them."""
    keys = encoded.filter(F.col("size") <= room).groupBy("pack_key").agg(
        F.ceil(F.sum("size") / F.lit(bucket_bytes)).cast("bigint").alias("buckets")
    )
    classed = (
        encoded.filter(F.col("size") <= room).join(keys, "pack_key")
        .withColumn("class", F.least(F.floor(F.lit(room) / F.col("size")), F.lit(SHARED_CLASS)).cast("int"))
        .withColumn("bucket", F.pmod(ids.digest_number(F.col("trace_id"), F.col("id")), F.col("buckets")))
        .drop("buckets")
    )
    group = ["pack_key", "class", "bucket"]
    totals = classed.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    earlier = Window.partitionBy("pack_key", "class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    n, size = _before(F.sum("n").over(earlier), F.sum("bytes").over(earlier))
    offsets = totals.select(*group, n.alias("n_before"), size.alias("bytes_before"))
    inside = Window.partitionBy(*group).orderBy(*_IDENTITY)
    running = classed.withColumns({
        "_nth": F.row_number().over(inside),
        "_end": F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    })
    return running.join(offsets, group).select(
        *encoded.columns, "class",
        (F.col("n_before") + F.col("_nth") - 1).alias("nth"),
        (F.col("bytes_before") + F.col("_end") - F.col("size")).alias("start"),
    )


def _gaps(large: DataFrame, room: int, small: int) -> DataFrame:
    """``pack_key``, ``batch``, where the gap starts and ends; those of a key end to end."""
    messages = large.groupBy("pack_key", "class", "message").agg((F.lit(room) - F.sum("size")).alias("gap"))
    laid = messages.withColumn("length", F.col("gap") - small + 1).filter("length > 0").withColumn(
        "part", F.floor(F.col("message") / BLOCK_MESSAGES)
    )
    group = ["pack_key", "class", "part"]
    earlier = Window.partitionBy("pack_key").orderBy("class", "part").rowsBetween(Window.unboundedPreceding, -1)
    totals = laid.groupBy(*group).agg(F.sum("length").alias("all")).withColumn(
        "before", _before(F.sum("all").over(earlier))[0]
    ).drop("all")
    inside = Window.partitionBy(*group).orderBy("message").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.col("before") + F.col("_end")
    return laid.withColumn("_end", F.sum("length").over(inside)).join(totals, group).select(
        "pack_key", _name(F.col("class"), F.col("message")).alias("batch"),
        (end - F.col("length")).alias("gap_start"), end.alias("gap_end"),
    )


def _name(size_class: Column, message: Column) -> Column:
    return F.concat(F.lit("c"), size_class.cast("string"), F.lit("-"), message.cast("string"))


def fill_messages(
    encoded: DataFrame, max_bytes: int = packing.QUEUE_MAX_BYTES, base64: bool = True,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Every encoded span with its size class (``packing``) and message (``batch``) of its pack key.

    Takes rows of ``packing.encode_spans``, one per span and none without a key, best from a table: they are
    read more than once.  The result goes to ``packing.queue_messages`` or ``stream_records`` as that of ``pack_spans`` does.  Within a
    class spans go by (bucket, trace ID, ID, kind).  A span that fits no message is ``oversize``, without a message.
    """
    room, small = room_and_small(max_bytes, base64)
    step = room - small + 1
    block_bytes = BLOCK_MESSAGES * room
    placed = _placed(encoded, room, bucket_bytes)
    large = placed.filter(F.col("class") < SHARED_CLASS).withColumn(
        "message", F.floor(F.col("nth") / F.col("class"))
    )
    gaps = _gaps(large, room, small)
    length = gaps.groupBy("pack_key").agg(F.max("gap_end").alias("filled"))
    spread = placed.filter(F.col("class") == SHARED_CLASS).join(length, "pack_key", "left").withColumn(
        "filled", F.coalesce("filled", F.lit(0))
    )
    columns = [*encoded.columns, "packing", "batch"]
    own = spread.filter(F.col("start") >= F.col("filled")).withColumn(
        "batch", F.concat(F.lit("b"), F.floor((F.col("start") - F.col("filled")) / step).cast("string"))
    )
    # a gap stands in each block that it reaches into, at most two
    block = F.explode(F.sequence(
        F.floor(F.col("gap_start") / block_bytes), F.floor((F.col("gap_end") - 1) / block_bytes)
    ))
    marks = gaps.withColumn("block", block).withColumn(
        "start", F.greatest(F.col("gap_start"), F.col("block") * block_bytes)
    )
    fillers = spread.filter(F.col("start") < F.col("filled")).withColumn(
        "block", F.floor(F.col("start") / block_bytes)
    )
    # the spans carry no message yet: their last one is that of the mark before them
    met = fillers.unionByName(marks.drop("gap_start", "gap_end"), allowMissingColumns=True)
    # marks come before the spans that start where they do
    order = Window.partitionBy("pack_key", "block").orderBy("start", F.col("size").asc_nulls_first())
    filling = met.withColumn(
        "batch", F.last("batch", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ).filter(F.col("size").isNotNull())
    shared = own.select(*encoded.columns, "batch").unionByName(filling.select(*encoded.columns, "batch"))
    return (
        large.withColumn("packing", F.concat(F.lit("class"), F.col("class").cast("string")))
        .withColumn("batch", _name(F.col("class"), F.col("message"))).select(columns)
        .unionByName(shared.withColumn("packing", F.lit(packing.SHARED)).select(columns))
        .unionByName(encoded.filter(F.col("size") > room).select(
            *encoded.columns, F.lit(OVERSIZE).alias("packing"), F.lit(None).cast("string").alias("batch")
        ))
    )
