"""Trace-consistent sampling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanloom.functions.ids import digest_number

BOUNDARIES = 10_000


def is_sampled(trace_id: Column, rate: float, debug: Column | None = None) -> Column:
    """True for the same traces everywhere: the decision depends on the trace ID alone.

    ``debug`` spans are always kept.
    """
    if not 0.0 <= rate <= 1.0:
        raise ValueError("rate must be between 0 and 1")
    picked = (digest_number(trace_id) % BOUNDARIES) < int(round(rate * BOUNDARIES))
    return picked if debug is None else F.coalesce(debug, F.lit(False)) | picked


def deferred_root_decision(
    trace_id: Column, request_decision: Column, rate: float, inherited: Column | None = None
) -> Column:
    """Sampling of a call: inherited, else the request rule's answer, else the trace sampler."""
    decided = F.coalesce(request_decision, is_sampled(trace_id, rate))
    return decided if inherited is None else F.coalesce(inherited, decided)
