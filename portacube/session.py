"""Spark session helpers."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "portacube") -> SparkSession:
    """Session for tests and local runs: ANSI on, UTC, AQE on, UI off."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    On a cluster the directory must be configured (``spark.checkpoint.dir``,
    a shared file system path).  Only a local-mode session without one gets a
    scratch directory, so tests and single-machine runs work out of the box.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; configure a shared directory for this cluster")
    path = tempfile.mkdtemp(prefix="portacube-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


#: whether an execution removes its shuffle files when it ends; else they stay until the driver's garbage collection
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _held(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    previous = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if previous is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, previous)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside remove their shuffle files as they end, so that a load of many jobs holds one job's at a time."""
    with _held(spark, SHUFFLE_CLEANUP_CONF, "true"):
        yield


#: rows in memory over their bytes in a stored table, as the planner takes it; Spark's own value is 1
UNPACKED_CONF, UNPACKED = "spark.sql.sources.fileCompressionFactor", "16.0"


@contextmanager
def sizes_unpacked(spark: SparkSession) -> Iterator[None]:
    """Joins planned inside take a stored table for as large as its rows, not as its packed files.

    A column of ids takes a byte or two a row in a zstd file, and about fifty
    in the table that a broadcast builds in the driver: by its file a table of
    millions of rows passes for a small one, and concurrent writes broadcast
    several.
    """
    with _held(spark, UNPACKED_CONF, UNPACKED):
        yield


def cluster_conf(executors: int = 1000, cores_per_executor: int = 8) -> dict[str, str]:
    """Settings for a large cluster (hundreds of TB of input).

    Many initial shuffle partitions (3 per core) that AQE coalesces to the
    advisory size, 256 MiB scan splits, skew-join splitting of partitions
    5x larger than the median, and a bounded broadcast threshold so only
    measured-small sides are broadcast.  ``spark.checkpoint.dir`` must point
    at the shared file system; it is not set here.
    """
    cores = executors * cores_per_executor
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.shuffle.partitions": str(3 * cores),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.compression.codec": "zstd",
    }
