"""Session settings and working folders."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that take effect at run time and that results depend on.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # two tags may become the same key once dots turn into underscores: the later one wins
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # message bodies must not contain line breaks
    "spark.sql.chunkBase64String.enabled": "false",
}

# On a cluster, state of streaming jobs lives on disk and not in executor memory.
CLUSTER_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings every operator relies on to a session somebody else made."""
    settings = RUNTIME_SETTINGS if is_local(spark) else {**RUNTIME_SETTINGS, **CLUSTER_SETTINGS}
    for key, value in settings.items():
        spark.conf.set(key, value)
    return spark


# Shuffles of a finished action are deleted at once instead of some time after nobody refers to them any more.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves its table only, so that on disk the steps of a job do not add up."""
    before = spark.conf.get(_DROP_SHUFFLES, "false")
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)


def is_local(spark: SparkSession) -> bool:
    """One process holds driver and executors; ``local-cluster`` is a cluster."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def local_session(cores: int | str = "*", name: str = "spanloom", **extra: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else str(cores))
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in {**RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach.

    A cluster names it in ``spark.checkpoint.dir``.  Only a local master may fall back to a
    temporary folder, because there driver and executors are one process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if is_local(spark):
        return tempfile.mkdtemp(prefix="spanloom-")
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder; nothing in it is ever reused."""
    return f"{shared_dir(spark)}/spanloom/{name}-{uuid.uuid4().hex}"
