"""Time the headline queries and print one JSON line.

Reads ``$BENCH_SF_DIR`` and runs on ``local[$BENCH_CPUS]``.  Each query is built and written to the
``noop`` sink, so every output column is computed; the figure is the median of ``$BENCH_RUNS`` runs
after one warm-up.

The given tables are one row group each, which only one task can read.  They are first written, untimed, as
several files to a folder of the run; all times are over those.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from spanloom import session
from spanloom.plans import catalog

HEADLINE = [
    "xray_segments", "xray_document", "decode_spans_json_v2", "collector_metrics",
    "parse_trace_header", "sdk_call_spans", "sdk_operation_spans", "publish_batch_spans",
    "inject_message_headers", "pack_spans", "dedup_spans", "get_traces", "get_dependencies",
    "correlate_logs", "metrics_by_window", "stream_ingest",
]


def in_files(spark: SparkSession, sf_dir: str, out: str, files: int) -> str:
    """The same tables, each as so many files."""
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)
        spark.read.parquet(path).repartition(files).write.parquet(f"{out}/{name}")
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 1))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    work = tempfile.mkdtemp(prefix="bench-")
    spark = session.local_session(cpus, "bench", **{"spark.checkpoint.dir": f"{work}/shared"})
    tables = in_files(spark, sf_dir, f"{work}/tables", int(cpus))
    queries = catalog.queries()
    timings: dict[str, float] = {}
    for name in names:
        seconds = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, tables).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(seconds[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total of medians",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
