"""The exact Euclidean silhouette of a stated query set against all rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators.blocks import Cell, deal, distances, meet, tasks_for

#: Clusters whose sums a cell holds before it gives them out, and rows in one matrix product.
_HELD, _STEP = 64, 1_024


class _Sums(Cell):
    """Sums of distances from every query to the rows of each cluster."""

    def __init__(self, keys, x, extra, group):
        super().__init__(keys, x, extra, group)
        self.sums: dict[int, list] = {}

    def add(self, keys, x, extra):
        for lo in range(0, len(x), _STEP):
            part, labels = x[lo:lo + _STEP], extra[lo:lo + _STEP]
            far = distances(self.x, part)
            for label in np.unique(labels):
                mine = labels == label
                held = self.sums.setdefault(int(label), [np.zeros(len(self.x)), 0])
                held[0] += far[:, mine].sum(axis=1)
                held[1] += int(mine.sum())
                if len(self.sums) >= _HELD:
                    yield from self.finish()

    def finish(self):
        for label, (total, n) in self.sums.items():
            size = len(self.keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.keys, pa.int64()), pa.array(self.extra, pa.int64()), pa.array(np.full(size, label), pa.int64()),
                 pa.array(total, pa.float64()), pa.array(np.full(size, n), pa.int64())],
                names=["k", "own", "label", "total", "n"])
        self.sums = {}


def cluster_distances(pts: DataFrame, asked: DataFrame) -> DataFrame:
    """(k, own, label, total, n): the sum of Euclidean distances from each row
    of ``asked`` to the rows of every cluster of ``pts``, and their number.
    Both are (key long, label, x array<double>) as ``cluster_metrics.points``
    gives them; rows without a vector or a label are left out."""
    def side(df):
        whole = df.where(F.col("x").isNotNull() & F.col("label").isNotNull() & F.col("key").isNotNull())
        return whole.select(F.lit(0).alias("g"), F.col("key").cast("long").alias("k"), "x", F.col("label").cast("long").alias("extra"))

    queries, rows = side(asked), side(pts)
    sizes = queries.count(), rows.count()
    tasks = tasks_for(pts.sparkSession, *sizes)
    met = meet(deal(queries, rows, sizes=sizes), _Sums, "k long, own long, label long, total double, n long", tasks)
    return met.groupBy("k", "own", "label").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def euclidean_silhouettes(pts: DataFrame, asked: DataFrame) -> DataFrame:
    """(key, label, silhouette) of the rows of ``asked``, each of which is a
    row of ``pts``, with unsquared Euclidean distance.  A row alone in its
    cluster, and every row where there is one cluster only, scores 0."""
    per = cluster_distances(pts, asked)
    own = F.col("label") == F.col("own")
    both = per.groupBy("k", "own").agg(
        F.max(F.when(own, F.col("n"))).alias("n"), F.max(F.when(own, F.try_divide(F.col("total"), F.col("n") - 1))).alias("a"),
        F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b"))
    s = F.when((F.col("n") <= 1) | F.col("b").isNull() | (F.greatest("a", "b") == 0), F.lit(0.0)).otherwise(
        (F.col("b") - F.col("a")) / F.greatest("a", "b"))
    return both.select(F.col("k").alias("key"), F.col("own").alias("label"), s.alias("silhouette"))
