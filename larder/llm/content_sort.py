"""Exact dedup by content sort (operator 6).

Normalised bytes are range-partitioned at sampled splitters, sorted
externally inside each partition, and every row is compared in full with its
neighbour.  The splitter key is the text's first ``key_bytes`` normalised
bytes, and behind them the digest stands for the rest, so a sampled splitter
stays small however long the texts are.  The identifier ends the key: a group
of copies that outgrows a partition is cut into several runs, each sorted in a
task of its own.  Only the first and last run of a partition can go on in a
neighbour, so at most two runs per partition are joined up afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.common import LOWER, UPPER, stored

#: Slice of an Arrow batch that is normalised at once (rows).
SLICE_ROWS = 1024

RUN_COLUMNS = [
    T.StructField("keep_id_", T.LongType()), T.StructField("size_", T.LongType()),
    T.StructField("first_", T.BooleanType()), T.StructField("part_", T.IntegerType()),
    T.StructField("run_", T.LongType()), T.StructField("edge_", T.StringType()),
]


def normalised(column):
    """Null counts as empty; only A-Z are lower-cased."""
    return F.translate(F.coalesce(column, F.lit("")), UPPER, LOWER)


class _Runs:
    """Cuts a sorted stream of rows into runs of equal normalised texts."""

    def __init__(self, schema: pa.Schema, part: int, text: str, key: str, all_rows: bool) -> None:
        self.schema, self.part, self.text, self.key, self.all_rows = schema, part, text, key, all_rows
        self.open: list[pa.RecordBatch] = []  # rows of the run that is still open
        self.last: str | None = None
        self.run = -1

    def feed(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        body = pc.ascii_lower(pc.fill_null(batch.column(self.text), ""))
        new = np.ones(len(body), dtype=bool)
        new[1:] = pc.not_equal(body[1:], body[:-1]).to_numpy(zero_copy_only=False)
        new[0] = self.last is None or body[0].as_py() != self.last
        self.last = body[-1].as_py()
        starts = np.flatnonzero(new)
        cut = 0 if len(starts) and starts[0] == 0 else (int(starts[0]) if len(starts) else batch.num_rows)
        if cut:
            self.open.append(batch.slice(0, cut))
        if not len(starts):
            return
        if self.open:
            yield from self._emit(self.open, np.array([0]), first_edge=self.run < 0)
            self.open = []
        done = int(starts[-1])
        if done > cut:
            yield from self._emit([batch.slice(cut, done - cut)], starts[:-1] - cut, first_edge=self.run < 0)
        self.open = [batch.slice(done)]

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.open:
            yield from self._emit(self.open, np.array([0]), first_edge=self.run < 0, last_edge=True)

    def _emit(self, pieces, starts, first_edge=False, last_edge=False) -> Iterator[pa.RecordBatch]:
        """Rows of complete runs; ``starts`` are the runs' first rows."""
        total = sum(p.num_rows for p in pieces)
        sizes = np.diff(np.append(starts, total))
        runs = np.arange(self.run + 1, self.run + 1 + len(starts))
        self.run += len(starts)
        edge = np.zeros(len(starts), dtype=bool)
        edge[0] |= first_edge
        edge[-1] |= last_edge
        if len(pieces) == 1:
            piece = pieces[0]
            ids = piece.column(self.key).take(pa.array(starts))
            keep = ids.take(pa.array(np.repeat(np.arange(len(starts)), sizes)))
            first = np.zeros(total, dtype=bool)
            first[starts] = True
            yield self._rows(piece, keep, np.repeat(sizes, sizes), first, np.repeat(runs, sizes), np.repeat(edge, sizes))
            return
        head = pieces[0].column(self.key)[0].as_py()
        for n, piece in enumerate(pieces):
            m = piece.num_rows
            first = np.zeros(m, dtype=bool)
            first[0] = n == 0
            yield self._rows(piece, pa.array([head] * m, pa.int64()), np.full(m, sizes[0]), first,
                             np.full(m, runs[0]), np.full(m, edge[0]))

    def _rows(self, piece, keep, size, first, run, edge) -> pa.RecordBatch:
        marked = np.flatnonzero(first & edge)  # one row of an edge run carries its text
        texts: list[str | None] = [None] * piece.num_rows
        for i in marked:
            texts[i] = pc.ascii_lower(pc.fill_null(piece.column(self.text).slice(int(i), 1), ""))[0].as_py()
        own = {"keep_id_": keep.cast(pa.int64()), "size_": pa.array(size, pa.int64()), "first_": pa.array(first),
               "part_": pa.array(np.full(piece.num_rows, self.part, dtype=np.int32)),
               "run_": pa.array(run, pa.int64()), "edge_": pa.array(texts, pa.string())}
        out = pa.RecordBatch.from_arrays(
            [own[f.name] if f.name in own else piece.column(f.name) for f in self.schema], schema=self.schema)
        return out if self.all_rows else out.filter(pa.array(first))


def _walk(schema: pa.Schema, text: str, key: str, all_rows: bool):
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Runs(schema, TaskContext.get().partitionId(), text, key, all_rows)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                yield from state.feed(batch.slice(at, SLICE_ROWS))
        yield from state.close()
    return walk


def _walked(df: DataFrame, id_col: str, text_col: str, keep: str, carry: list[str], all_rows: bool,
            partitions: int | None, key_bytes: int) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    if keep not in ("min", "max"):
        raise ValueError("keep is 'min' or 'max'")
    body = normalised(F.col(text_col))
    rows = df.select(F.col(id_col).cast("long").alias("id_"), F.col(text_col).alias("text_"),
                     F.sha2(body, 256).alias("digest_"), F.substring(body.cast("binary"), 1, key_bytes).alias("head_"),
                     *[F.col(c).alias(f"c{n}_") for n, c in enumerate(carry)])
    by_id = F.col("id_").asc_nulls_last() if keep == "min" else F.col("id_").desc_nulls_last()
    key = ["head_", "digest_", by_id]
    dealt = rows.repartitionByRange(partitions, *key) if partitions else rows.repartitionByRange(*key)
    fields = [T.StructField("id_", T.LongType()), T.StructField("digest_", T.StringType()),
              *[T.StructField(f"c{n}_", df.schema[c].dataType) for n, c in enumerate(carry)], *RUN_COLUMNS]
    schema = T.StructType(fields)
    return dealt.sortWithinPartitions(*key).drop("head_").mapInArrow(
        _walk(to_arrow_schema(schema), "text_", "id_", all_rows), schema)


def _joined_runs(walked: DataFrame) -> DataFrame:
    """Runs that go on in a neighbouring partition: their group's keeper and
    size, and whether the run comes first.  At most two rows per partition."""
    edges = walked.filter("edge_ is not null").select("edge_", "part_", "run_", "keep_id_", "size_")
    groups = (edges.groupBy("edge_")
              .agg(F.min(F.struct("part_", "run_", "keep_id_")).alias("lead"), F.sum("size_").alias("g_size"),
                   F.count("*").alias("n")).filter("n > 1"))
    return (edges.join(groups, "edge_")
            .select("part_", "run_", F.col("lead.keep_id_").alias("g_keep"), "g_size",
                    ((F.col("part_") == F.col("lead.part_")) & (F.col("run_") == F.col("lead.run_"))).alias("g_lead")))


def _resolved(walked: DataFrame) -> DataFrame:
    # Bounded: two fixed-width rows per partition of the sort.
    runs = F.broadcast(_joined_runs(walked))
    return walked.join(runs, ["part_", "run_"], "left")


def content_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
                   partitions: int | None = None, key_bytes: int = 64) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, digest.

    Texts are equal when identical after lower-casing A-Z; a null text counts
    as empty.  ``keep`` names the identifier that stays, the smallest or the
    largest; a null identifier stays only where its group has no other, and of
    rows repeated with the same identifier and text exactly one is kept.  An
    empty table gives an empty result; other columns are not read."""
    walked = stored(_walked(df, id_col, text_col, keep, [], True, partitions, key_bytes), "content-sort")
    lead = F.coalesce(F.col("g_lead"), F.lit(True))
    return _resolved(walked).select(
        F.col("id_").alias("doc_id"),
        F.when(F.col("g_size").isNotNull(), F.col("g_keep")).otherwise(F.col("keep_id_")).alias("keep_id"),
        F.coalesce("g_size", "size_").alias("group_size"), (F.col("first_") & lead).alias("kept"),
        F.col("digest_").alias("text_sha256"))


def distinct_contents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
                      partitions: int | None = None, key_bytes: int = 64) -> DataFrame:
    """The rows of ``df`` that ``content_groups`` keeps, all columns unchanged."""
    carry = df.columns
    walked = stored(_walked(df, id_col, text_col, keep, carry, False, partitions, key_bytes), "content-rows")
    return (_resolved(walked).filter(F.coalesce(F.col("g_lead"), F.lit(True)))
            .select(*[F.col(f"c{n}_").alias(c) for n, c in enumerate(carry)]))
