"""Links between services whose spans do not follow each other directly.

Spans of a trace form a forest.  Between two services there may be local spans, spans without a service, or
spans that never reached the store.  Links go to the nearest ancestor of another service, found by pointer
doubling: in each round a pointer takes over the pointer of the span it points at, so a chain of 1,000 spans takes ten.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom import session
from spanloom.operators import store

_INCOMING = "kind IN ('SERVER', 'CONSUMER')"
_OUTGOING = "kind IN ('CLIENT', 'PRODUCER')"
#: Stands behind the ID of the calling half of a span whose ID both ends of the call share.
_CALLER = "/caller"


def _kept(df: DataFrame, name: str) -> DataFrame:
    """A table in the shared folder: cuts the lineage between rounds; the shuffles behind it go."""
    path = session.new_run_dir(df.sparkSession, name)
    with session.dropping_shuffles(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _failed() -> Column:
    status = F.col("tags")["http.status_code"].try_cast("int")
    return F.col("tags")["error"].isNotNull() | F.coalesce(status >= 500, F.lit(False))


def _facts(spans: DataFrame) -> DataFrame:
    """What links need of a span: no tags, only what they say of a failure."""
    return spans.select(
        "trace_id", "id", "parent_id", "kind", "timestamp", "local_service", "remote_service",
        _failed().alias("failed"),
    )


def _nodes(spans: DataFrame) -> DataFrame:
    """``(trace_id, node, up, ...)``: one row per end of each span of ``_facts``; ``up`` is the node it hangs on.

    Of several spans of one end the first in the order of (service, remote service, parent, kind) counts, nulls first.
    """
    fields = F.struct(
        F.col("local_service").alias("service"), F.col("remote_service").alias("remote"), "parent_id", "kind",
        "timestamp", "failed",
    )
    incoming = F.coalesce(F.expr(_INCOMING), F.lit(False))
    ends = spans.groupBy("trace_id", "id").agg(
        F.min(F.when(incoming, fields)).alias("callee"), F.min(F.when(~incoming, fields)).alias("caller")
    )
    shared = F.col("callee").isNotNull() & F.col("caller").isNotNull()
    below = F.concat("id", F.lit(_CALLER))
    callee = F.struct(
        F.col("id").alias("node"), F.when(shared, below).otherwise(F.col("callee.parent_id")).alias("up"),
        F.col("callee").alias("span"), F.lit(False).alias("answered"),
    )
    caller = F.struct(
        F.when(shared, below).otherwise(F.col("id")).alias("node"), F.col("caller.parent_id").alias("up"),
        F.col("caller").alias("span"), shared.alias("answered"),
    )
    both = F.filter(F.array(callee, caller), lambda end: end["span"].isNotNull())
    return ends.select("trace_id", F.explode(both).alias("end")).select(
        "trace_id", "end.node", "end.up", "end.span.*", "end.answered"
    ).drop("parent_id")


def nearest(pointers: DataFrame, rounds: int) -> DataFrame:
    """Where pointers end: ``(trace_id, node, up, service)`` for those that reach a found one.

    ``pointers`` has ``trace_id, node, up, service, found``, one row per node.  A found pointer stays; another
    one takes over that of the node it points at, and has no end if there is none.  After ``rounds`` rounds it went
    2^rounds steps; what still moves then runs in a circle and has no end.

    Pointers are written once, so that what made them runs once, and then only those that move.  Both sides
    of the join are tables, so that adaptive execution may split a node that very many others point at.
    """
    found, up = F.col("found"), F.col("up").isNotNull()
    begun = _kept(pointers, "pointers")
    settled, moving = [begun.filter(found | ~up)], begun.filter(~found & up)
    for _ in range(rounds):
        if moving.isEmpty():
            break
        every = reduce(DataFrame.union, [*settled, moving]).select(
            F.col("trace_id").alias("_trace"), F.col("node").alias("_node"), F.col("up").alias("_up"),
            F.col("service").alias("_service"), F.col("found").alias("_found"),
        )
        moved = moving.join(every, (F.col("trace_id") == F.col("_trace")) & (F.col("up") == F.col("_node")), "left")
        step = _kept(
            moved.select(
                "trace_id", "node", F.col("_up").alias("up"), F.col("_service").alias("service"),
                F.coalesce("_found", F.lit(False)).alias("found"),
            ), "step",
        )
        settled.append(step.filter(found | ~up))
        moving = step.filter(~found & up)
    return reduce(DataFrame.union, settled).filter("found").drop("found")


def _callers(nodes: DataFrame) -> DataFrame:
    """``(trace_id, node, up, service)``: of each node the nearest ancestor with another service.

    For nodes without a service, that is the nearest one with any.
    """
    size = nodes.groupBy("trace_id").count().agg(F.max("count")).first()[0]
    rounds = math.ceil(math.log2(size or 1)) + 2
    named = nodes.select(
        F.col("trace_id").alias("_trace"), F.col("node").alias("_node"), F.col("service").alias("_service")
    )
    above = (F.col("trace_id") == F.col("_trace")) & (F.col("up") == F.col("_node"))
    first = nodes.join(named, above, "left").select(
        "trace_id", "node", F.when(F.col("_node").isNotNull(), F.col("up")).alias("up"),
        F.col("_service").alias("service"), F.col("_service").isNotNull().alias("found"),
    )
    hosts = nearest(first, rounds)
    own = nodes.select(F.col("trace_id").alias("_trace"), F.col("node").alias("_node"), F.col("service").alias("_own"))
    second = hosts.join(own, (F.col("trace_id") == F.col("_trace")) & (F.col("node") == F.col("_node"))).select(
        "trace_id", "node", "up", "service", (F.col("_own").isNull() | (F.col("_own") != F.col("service"))).alias("found")
    )
    return nearest(second, rounds)


def service_links(spans: DataFrame, end_ts: int, lookback: int) -> DataFrame:
    """Calls and errors per parent and child service; window in milliseconds.  Columns as ``get_dependencies``.

    * An incoming span in the window is a call from the nearest ancestor of another service; without one, because
      the trace begins there, a parent is absent or parents run in a circle, from the span's own remote service.
    * An outgoing span in the window that nothing answers (no span hangs on it, none shares its ID) is a call
      to its remote service, from its service or the nearest ancestor's.

    A service does not call itself.  Ancestors may be of any time; only traces with a span in the window are read
    further.  Spans without trace ID or ID take no part, copies of a span count once.
    """
    start, end = (end_ts - lookback) * 1000, end_ts * 1000
    known = spans.filter(F.col("trace_id").isNotNull() & F.col("id").isNotNull())
    recent = store.between(known, start, end, undated=False).select("trace_id").distinct()
    # the tags are done with before the spans move
    nodes = _kept(_nodes(_facts(known).join(recent, "trace_id", "left_semi")), "nodes")
    callers = _callers(nodes).select(
        F.col("trace_id").alias("_trace"), F.col("node").alias("_node"), F.col("service").alias("_caller")
    )
    parents = nodes.filter("up IS NOT NULL").select(
        F.col("trace_id").alias("_trace"), F.col("up").alias("_up")
    ).distinct()
    now = nodes.filter(F.col("timestamp").between(start, end))
    of_node = (F.col("trace_id") == F.col("_trace")) & (F.col("node") == F.col("_node"))
    incoming = now.filter(F.expr(_INCOMING) & F.col("service").isNotNull()).join(callers, of_node, "left").select(
        F.coalesce("_caller", "remote").alias("parent"), F.col("service").alias("child"), "failed"
    )
    unanswered = now.filter(F.expr(_OUTGOING) & F.col("remote").isNotNull() & ~F.col("answered")).join(
        parents, (F.col("trace_id") == F.col("_trace")) & (F.col("node") == F.col("_up")), "left_anti"
    )
    outgoing = unanswered.join(callers, of_node, "left").select(
        F.coalesce("service", "_caller").alias("parent"), F.col("remote").alias("child"), "failed"
    )
    return incoming.union(outgoing).filter("parent != child").groupBy("parent", "child").agg(
        F.count(F.lit(1)).alias("call_count"), F.count_if("failed").alias("error_count")
    )
