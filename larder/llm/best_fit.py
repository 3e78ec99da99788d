"""Best-fit decreasing packing of token sequences (operator 1).

Pieces are taken from the longest to the shortest, and each goes into the
tightest open sequence that still has room; a segment tree over the remaining
capacities finds it in logarithmic time.

Best fit sees a piece only through its length, and there are at most
``capacity`` lengths.  So the plan is made for all pieces at once from the
counts of the lengths: pieces of one length, and open sequences with the same
remaining capacity, are moved in runs.  The plan's size depends on the
capacity and not on the data, and it equals the plan that takes the pieces one
by one.  Pieces find their places by their rank among the pieces of their
length, in parallel.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larder.llm.common import stored
from larder.llm.encode import encoder, slices

CAPACITY = 2048
#: Rows of a batch of pieces that a task returns at once.
PIECES_SCHEMA = "doc_id long, piece int, start long, length long, ids binary, task int, own_rank long"


class TightestFit:
    """Segment tree over the remaining capacities 0..capacity."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, room: int, n: int) -> None:
        at = self.leaves + room
        while at:
            self.count[at] += n
            at >>= 1

    def find(self, least: int) -> int | None:
        """The smallest remaining capacity of at least ``least`` that an open sequence has."""
        at = self.leaves + least
        if self.count[at]:
            return least
        while at > 1:
            if at % 2 == 0 and self.count[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


@dataclass
class Plan:
    """For each length: from which rank on (``ranks``) pieces go ``per`` by
    ``per`` into the sequences from ``first`` on, at ``offset`` and behind."""

    ranks: dict[int, np.ndarray]
    first: dict[int, np.ndarray]
    per: dict[int, np.ndarray]
    offset: dict[int, np.ndarray]
    sequences: int


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Best-fit decreasing of ``counts[length]`` pieces of each length."""
    tree = TightestFit(capacity)
    open_runs: dict[int, list[tuple[int, int]]] = {}  # remaining capacity: (first sequence, how many)
    sequences, steps = 0, {}

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            open_runs.setdefault(room, []).append((first, n))
            tree.add(room, n)

    for length in sorted(counts, reverse=True):
        left, rank, own = counts[length], 0, []
        while left:
            room = tree.find(length)
            if room is None:  # only new sequences are left
                room, n = capacity, -(-left // (capacity // length))
                first = sequences
                sequences += n
            else:
                first, n = open_runs[room].pop()
                tree.add(room, -n)
            each = room // length  # a sequence that got one piece is the tightest for the next
            full = min(n, left // each)
            if full:
                own.append((rank, first, each, capacity - room))
                put(room - each * length, first, full)
                rank, left, first, n = rank + full * each, left - full * each, first + full, n - full
            if n and 0 < left < each:
                own.append((rank, first, each, capacity - room))
                put(room - left * length, first, 1)
                rank, left, first, n = rank + left, 0, first + 1, n - 1
            put(room, first, n)
        steps[length] = [np.array(x, dtype=np.int64) for x in zip(*own, strict=True)]
    columns = [{k: v[n] for k, v in steps.items() if v} for n in range(4)]
    return Plan(*columns, sequences)


def _cut(tokenizer: str, end_id: int, capacity: int, added_tokens: bool):
    end = np.array([end_id], dtype="<u4").tobytes()
    names = [f.split()[0] for f in PIECES_SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(tokenizer, added_tokens).encode, TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in slices(texts):
                rows = []
                for doc, tokens in zip(ids[a:b], encode(texts[a:b]), strict=True):
                    tokens += end
                    n = len(tokens) // 4
                    start, piece = 0, 0
                    length = n % capacity or min(n, capacity)  # the first piece takes what is over
                    while start < n:
                        rows.append((doc, piece, start, length, tokens[4 * start:4 * (start + length)], task, seen[length]))
                        seen[length] += 1
                        start, piece, length = start + length, piece + 1, capacity
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
    return cut


def token_pieces(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0,
                 capacity: int = CAPACITY, added_tokens: bool = True) -> DataFrame:
    """Pieces of at most ``capacity`` ids, stored: doc_id, piece, start, length,
    ids (little-endian unsigned 32-bit), and the piece's rank among those of
    its length in its task.  Only a text of more ids is cut; its first piece
    takes what does not fill a whole one.  The names of the file's added tokens
    in a text give their ids, or with ``added_tokens=False`` are ordinary text."""
    given = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return stored(given.mapInArrow(_cut(tokenizer, end_id, capacity, added_tokens), PIECES_SCHEMA), "pieces")


def _placed(plan: Plan):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank_").to_numpy()
            sequence, offset = np.empty(len(rank), dtype=np.int64), np.empty(len(rank), dtype=np.int64)
            for value in np.unique(length).tolist():
                at = np.flatnonzero(length == value)
                step = np.searchsorted(plan.ranks[value], rank[at], side="right") - 1
                beyond = rank[at] - plan.ranks[value][step]
                per = plan.per[value][step]
                sequence[at] = plan.first[value][step] + beyond // per
                offset[at] = plan.offset[value][step] + beyond % per * value
            kept = [n for n in batch.schema.names if n != "rank_"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(sequence), pa.array(offset)],
                names=[*kept, "sequence_id", "offset"])
    return place


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to stored pieces (``token_pieces``).

    Columns besides length, task and own_rank are passed through.  No piece is
    lost or cut: every sequence has at most ``capacity`` ids without gaps.  An
    empty table gives an empty result."""
    spark = pieces.sparkSession
    by_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    counts = {r.length: r.n for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = plan_packing(counts, capacity)
    upto = F.sum("n").over(Window.partitionBy("length").orderBy("task"))
    before = by_task.select("length", "task", (upto - F.col("n")).alias("before"))
    carried = [c for c in pieces.columns if c not in ("task", "own_rank")]
    ranked = (pieces.join(before, ["length", "task"])
              .select(*carried, (F.col("before") + F.col("own_rank")).alias("rank_")))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.select(*carried).schema)
    placed = ranked.mapInArrow(_placed(plan), f"{fields}, sequence_id long, offset long")
    return placed if counts else spark.createDataFrame([], placed.schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, length, ids (binary) and
    the documents in them, in order of their offsets.  A sequence holds at
    most ``capacity`` pieces."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(0).cast("long"), lambda n, x: n + x["length"]).alias("length"),
        F.aggregate("p", F.lit(b"").cast("binary"), lambda b, x: F.concat(b, x["ids"])).alias("ids"),
        F.transform("p", lambda x: F.struct(x["doc_id"], x["piece"], x["offset"])).alias("documents"))
