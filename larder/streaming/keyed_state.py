"""X1 with keyed state: a stream whose state store holds the latest row per key.

The state is a streaming aggregate in update mode, so a micro-batch shuffles its
own rows and emits the latest row of the keys that it touches; a late row emits
the row that the state already holds.  The state lives in RocksDB, off the heap,
one store per shuffle partition.

The sink keeps a snapshot and the changes since.  Once the changes outweigh the
snapshot they are folded into a new one, and what it replaces goes.  A fold reads
at most twice the bytes of the changes that caused it, give or take one batch, so
folds cost a constant share of what is written; and a reader scans at most two
snapshots and one batch, however long the stream has run.

A batch that is replayed after a failure writes the same rows to its own folder
again.  A fold is complete once its folder has Spark's ``_SUCCESS`` file; until
then, readers and the next fold use the one before.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from larder.sources.ingest import latest_per_key

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Table:
    """Folders ``changes/N`` (rows of batch N) and ``snapshot/N`` (the table after batch N) below ``path``."""

    def __init__(self, spark: SparkSession, path: str, key: str, order_cols: Iterable[str], schema: StructType):
        self.spark, self.path, self.key, self.order_cols, self.schema = spark, path.rstrip("/"), key, list(order_cols), schema
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _complete(self, kind: str) -> list[int]:
        """Numbers of the folders of a kind that were written to the end."""
        folder = self._path(f"{self.path}/{kind}")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n) for n in names if re.fullmatch(r"\d+", n) and self._fs.exists(self._path(f"{self.path}/{kind}/{n}/_SUCCESS")))

    def folders(self) -> list[str]:
        """What a reader scans: the newest snapshot and the changes after it."""
        snapshots = self._complete("snapshot")[-1:]
        after = snapshots[0] if snapshots else -1
        return [f"snapshot/{n}" for n in snapshots] + [f"changes/{n}" for n in self._complete("changes") if n > after]

    def size(self, folders: Iterable[str]) -> int:
        return sum(self._fs.getContentSummary(self._path(f"{self.path}/{f}")).getLength() for f in folders)

    def read(self) -> DataFrame:
        """The latest row per key; no rows before the first batch."""
        folders = self.folders()
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in folders])
        return latest_per_key(rows, self.key, self.order_cols).select(*self.schema.names)

    def write_changes(self, rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/changes/{batch}")
        self.fold(batch)

    def fold(self, batch: int) -> bool:
        """Fold the changes up to ``batch`` if they outweigh the snapshot."""
        scanned = self.folders()
        changes = [f for f in scanned if f.startswith("changes/")]
        if not changes or self.size(changes) <= self.size(set(scanned) - set(changes)):
            return False
        self.read().write.mode("overwrite").parquet(f"{self.path}/snapshot/{batch}")
        # The snapshot before this one stays, for readers that have already listed it.
        kept = self._complete("snapshot")[-2:]
        for kind, last in (("snapshot", kept[0] - 1), ("changes", kept[0] if len(kept) > 1 else -1)):
            for n in self._complete(kind):
                if n <= last:
                    self._fs.delete(self._path(f"{self.path}/{kind}/{n}"), True)
        return True


def run_keyed_stream(source: DataFrame, table: Table, checkpoint: str,
                     clean: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Drive ``source`` (a streaming DataFrame) to completion with an
    availableNow trigger and keep ``table`` up to date.

    Rows of a null key are one key.  Among rows that agree in ``order_cols``
    an arbitrary one stays, so these should end with an identifier.  The
    number of state stores is ``spark.sql.shuffle.partitions`` at the first
    start of a checkpoint."""
    spark = source.sparkSession
    rows = latest_per_key(clean(source) if clean else source, table.key, table.order_cols).select(*table.schema.names)
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:  # a query takes the setting over when it starts
        query = (rows.writeStream.outputMode("update").foreachBatch(table.write_changes).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)
    query.awaitTermination()
