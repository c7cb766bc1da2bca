"""Session settings, the shared work folder and scoped caching."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Adaptive execution does the partition sizing: the initial number of shuffle partitions is
# only an upper bound that small stages coalesce down from, and hot partitions are split.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Methods above 8 kB of bytecode are never compiled by the JVM: let Spark fall back to
    # smaller methods before that instead of running the stage interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**ADAPTIVE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def adaptive_profile(spark: SparkSession):
    """The library's runtime settings for the duration of a block, whatever the session has."""
    return settings(spark, ADAPTIVE_CONF)

# Rows come out of compressed Parquet many times larger: tasks that sort or group what they read take
# small splits, whose rows fit in their memory, and stored rows are packed closely.  Shuffle files go
# when their query ends; otherwise they stay until the driver's next garbage collection.
COMPACT_CONF = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def compact_profile(spark: SparkSession):
    """Small input splits, zstd files and no shuffle files left behind for the duration of a block."""
    return settings(spark, COMPACT_CONF)


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[SparkSession]:
    """Runtime settings for the duration of a block."""
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield spark
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's checkpoint folder.

    Only a local session without that setting gets a scratch folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_run_dir(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def held(*frames: DataFrame) -> Iterator[tuple[DataFrame, ...]]:
    """Persist frames for the duration of a block and release them in reverse order.

    Blocks spill to local disk and are recomputed from lineage if an executor is lost.
    """
    kept: list[DataFrame] = []
    try:
        for frame in frames:
            kept.append(frame.persist(StorageLevel.MEMORY_AND_DISK))
        yield tuple(kept)
    finally:
        for frame in reversed(kept):
            frame.unpersist()
