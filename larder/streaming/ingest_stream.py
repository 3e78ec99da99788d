"""Incremental ingest with upsert, as a Structured Streaming job.

``readStream`` (explicit schema) -> clean -> ``foreachBatch`` appends the
batch's latest row per key to a change log, one partition folder per batch.
The table is the latest row per key over the log (``latest_per_key`` is
associative and commutative, so late rows and any split into batches give the
same table).  A micro-batch writes its own rows only and never rewrites what
other batches have written; a batch that is replayed after a failure
overwrites its own folder, so the sink is idempotent, and the streaming
checkpoint makes the job restartable after executor or driver loss.
``trigger(availableNow=True)`` processes everything landed so far and stops.

A reader of the log scans all of it until it is compacted.  ``keyed_state`` keeps
the latest rows in Spark's state store instead and bounds what a reader scans;
the registered query uses it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larder.session import ensure_checkpoint_dir
from larder.sources.ingest import latest_per_key
from larder.streaming.keyed_state import Table, run_keyed_stream


def run_upsert_stream(source: DataFrame, log: str, key: str, order_cols: Iterable[str], checkpoint: str,
                      clean: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Drive ``source`` (a streaming DataFrame) to completion with an
    availableNow trigger, logging the latest row per key of every batch."""
    order_cols = list(order_cols)

    def log_batch(batch: DataFrame, batch_id: int) -> None:
        rows = latest_per_key(clean(batch) if clean else batch, key, order_cols)
        (rows.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(log))

    query = (source.writeStream.foreachBatch(log_batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def current_table(spark: SparkSession, log: str, key: str, order_cols: Iterable[str]) -> DataFrame:
    """The table that the log describes: the latest row per key."""
    return latest_per_key(spark.read.parquet(log).drop("_batch"), key, order_cols)


def compact(spark: SparkSession, log: str, target: str, key: str, order_cols: Iterable[str]) -> None:
    """Write the current table as the first batch of a new log, so that a long
    log is read once; the caller points the next stream to ``target``."""
    table = current_table(spark, log, key, order_cols)
    table.withColumn("_batch", F.lit(-1)).write.mode("overwrite").partitionBy("_batch").parquet(target)


def stream_latest_events(spark: SparkSession, sf_dir: str, schema: StructType | None = None, files: int = 6) -> DataFrame:
    """Latest event per user, maintained incrementally from the ``events``
    table.  The table is landed as ``files`` files that are dealt by hash, so
    every micro-batch (one file each) holds rows older than those already
    in the state (``keyed_state``); the result equals the batch ``latest_per_key``."""
    base = ensure_checkpoint_dir(spark)
    run = f"{base.rstrip('/')}/larder-stream-{uuid.uuid4().hex}"
    columns = ["user_id", "event_id", "ts", "event_type", "value"]
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").select(*columns)
    events.repartition(files, F.xxhash64("event_id")).write.parquet(f"{run}/landed")
    source = (spark.readStream.schema(schema or events.schema).option("maxFilesPerTrigger", 1).parquet(f"{run}/landed"))
    table = Table(spark, f"{run}/table", "user_id", ["ts", "event_id"], events.schema)
    run_keyed_stream(source, table, f"{run}/checkpoint")
    return table.read()
