"""Spark session helpers.

The session is configured the way a cluster job would be: AQE on (runtime
re-planning, partition coalescing, skew-join splitting), UTC session time
zone, Arrow for the few pandas hand-offs, and no UI server.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
from contextlib import contextmanager, suppress

import pyarrow as pa
from pyspark.sql import SparkSession


def get_spark(app: str = "larder", master: str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        # Local mode: the driver JVM is the only executor, and its heap
        # defaults to 1 GB.  On a cluster, spark-submit sizes the executors.
        builder = builder.config("spark.driver.memory", os.environ.get("LARDER_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of the session.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``.
    Only a local-mode session without that setting (tests, the bench) gets a
    fresh scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="larder-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def cut_lineage(df):
    """Reliable checkpoint (never a local one): survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def arrow_rows(spark, most: int):
    """Batches of at most ``most`` rows between the JVM and Python for jobs run
    within: rows that carry a whole text's words are large ones."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def give_back() -> None:
    """Hand the free memory of this Python worker, which waits for its next task, back to the system."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)
