"""Bisecting K-Means for many cluster counts at once.

The fits of all counts start with the same splits and part only where a count
needs fewer splits of a level than others.  Splits that several counts share are
found once, and all splits of a level share their passes over the rows: a task
walks every row down the splits so far and sums the rows of both halves of the
open ones.  Spark adds the sums per half, and the driver sees one row per half.
A split whose centres stay leaves the passes: further rounds would change nothing.

The method is that of Spark's ``BisectingKMeans``: level by level, larger
clusters first where not all are needed, halves that start on both sides of the
centre, a fixed number of rounds.  The random numbers of a level are drawn in the
order of its clusters, where Spark takes the order in which it collects them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators.kmeans_sweep import _PASS_STEP, _dense, _steps
from larder.operators.mixtures import silhouettes

#: Levels of splits at most, and the cost of a row below which a cluster is not split.
_LEVELS, _NO_COST = 62, 2.0 ** -52


@dataclass(eq=False)
class Node:
    """A cluster: the split and half that it is (none for all rows), and the sums of its rows."""
    split: Split | None = None
    half: int = 0
    size: float = 0.0
    squares: float = 0.0
    sums: np.ndarray | None = None

    @property
    def center(self) -> np.ndarray:
        return self.sums / self.size

    @property
    def cost(self) -> float:
        return max(self.squares - self.size * float(self.center @ self.center), 0.0)


@dataclass(eq=False)
class Split:
    """Two centres that divide the rows of a node; a half without rows has none."""
    parent: Node
    centers: list[np.ndarray | None]
    halves: list[Node] = field(default_factory=list)


class _Draws:
    """Uniform numbers of Java's generator, which Spark's fits draw from."""

    def __init__(self, state: int):
        self.state = state

    def _bits(self, n: int) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
        return self.state >> (48 - n)

    def take(self, n: int) -> np.ndarray:
        return np.array([((self._bits(26) << 27) + self._bits(27)) / (1 << 53) for _ in range(n)])


def _layout(splits: Sequence[Split]) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Per split the row of its parent in ``_inside`` (-1: all rows); the centres of
    both halves side by side and their squares, infinite where there is no centre."""
    at = {id(s): i for i, s in enumerate(splits)}
    parents = [-1 if s.parent.split is None else 2 * at[id(s.parent.split)] + s.parent.half for s in splits]
    width = len(splits[0].parent.sums)
    centers = np.array([np.zeros(width) if c is None else c for s in splits for c in s.centers])
    gone = np.array([c is None for s in splits for c in s.centers])
    return parents, centers, np.where(gone, np.inf, (centers * centers).sum(axis=1))


def _inside(x: np.ndarray, layout: tuple[list[int], np.ndarray, np.ndarray]) -> np.ndarray:
    """Which rows are in which half (two rows per split, parents first); ties stay left."""
    parents, centers, squares = layout
    far = (x * x).sum(axis=1) + squares[:, None] - 2 * (centers @ x.T)
    right = far[1::2] < far[::2]
    out = np.empty((len(centers), len(x)), dtype=bool)
    for i, parent in enumerate(parents):
        held = out[parent] if parent >= 0 else True
        out[2 * i], out[2 * i + 1] = held & ~right[i], held & right[i]
    return out


def _sums(dense: DataFrame, splits: Sequence[Split], open_: Sequence[Split]) -> dict[int, np.ndarray]:
    """(rows, squares, sums) of both halves of the open splits, by place; without splits, of all rows."""
    layout = _layout(splits) if splits else None
    at = {id(s): i for i, s in enumerate(splits)}
    wanted = np.array([2 * at[id(s)] + half for s in open_ for half in (0, 1)])

    def sums(batches):
        total = None
        for x in _steps(batches, 2 * len(splits) + 2, _PASS_STEP):
            rows = np.hstack([np.ones((len(x), 1)), (x * x).sum(axis=1)[:, None], x])
            held = _inside(x, layout)[wanted].astype(float) if layout else np.ones((1, len(x)))
            total = held @ rows if total is None else total + held @ rows
        if total is not None:
            some = np.flatnonzero(total[:, 0])
            values = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * total.shape[1], pa.int32()), pa.array(total[some].ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), values], names=["c", "s"])

    parts = dense.mapInArrow(sums, "c int, s array<double>")
    added = parts.groupBy("c").agg(vector_to_array(Summarizer.sum(array_to_vector("s"))).alias("s"))
    return {r.c: np.array(r.s) for r in added.collect()}  # one row per half


def _divide(dense: DataFrame, known: Sequence[Split], new: Sequence[Split], max_iter: int) -> None:
    """Lloyd's rounds of all new splits, which fill in their halves; ``known`` are those they hang on."""
    open_ = list(new)
    for _ in range(max_iter):
        if not open_:
            break
        found, still = _sums(dense, [*known, *new], open_), []
        for i, split in enumerate(open_):
            split.halves = [Node(split, half, *found[2 * i + half][:2], found[2 * i + half][2:]) for half in (0, 1) if 2 * i + half in found]
            before, split.centers = split.centers, [None, None]
            for node in split.halves:
                split.centers[node.half] = node.center
            if any((a is None) != (b is None) or a is not None and np.abs(a - b).max() > 1e-12 for a, b in zip(before, split.centers, strict=True)):
                still.append(split)
        open_ = still


def bisecting_trees(features: DataFrame, ks: Sequence[int], seed: int = 42, max_iter: int = 20) -> tuple[Node | None, dict[int, list[Split]]]:
    """All rows as one node (None without rows), and the splits of the tree of every cluster count, parents first."""
    dense = _dense(features)
    found = _sums(dense, [], [])
    if not found:
        return None, {}
    root = Node(None, 0, *found[0][:2], found[0][2:])
    trees = {k: [] for k in ks}
    # Counts whose splits are the same so far: (counts, nodes of the last level, splits made, generator).
    courses = [(list(ks), [root], 0, _Draws((seed ^ 0x5DEECE66D) & ((1 << 48) - 1)))]
    known = []
    for _ in range(_LEVELS):
        planned = []
        for counts, nodes, made, draws in courses:
            able = [n for n in nodes if n.cost > _NO_COST * n.size]
            for take in sorted({min(k - 1 - made, len(able)) for k in counts} - {0}):
                chosen = able if take == len(able) else sorted(able, key=lambda n: -n.size)[:take]
                own, splits = _Draws(draws.state), []
                for node in chosen:
                    shift = 1e-4 * np.sqrt(node.center @ node.center) * own.take(len(node.sums))
                    splits.append(Split(node, [node.center - shift, node.center + shift]))
                planned.append(([k for k in counts if min(k - 1 - made, len(able)) == take], splits, made + take, own))
        if not planned:
            break
        new = [s for _, splits, _, _ in planned for s in splits]
        _divide(dense, known, new, max_iter)
        known += new
        for counts, splits, _, _ in planned:
            for k in counts:
                trees[k] += splits
        courses = [(counts, [n for s in splits for n in s.halves], made, own) for counts, splits, made, own in planned]
    return root, trees


def _leaves(root: Node, splits: Sequence[Split]) -> list[Node]:
    divided = {id(s.parent) for s in splits}
    return [n for n in [root, *[n for s in splits for n in s.halves]] if id(n) not in divided]


def bisecting_sweep(spark: SparkSession, features: DataFrame, ks: Sequence[int], seed: int = 42, max_iter: int = 20) -> DataFrame:
    """(k, n_clusters, silhouette, cost) for every count: clusters that hold rows,
    silhouette (squared Euclidean; null for one cluster) and the sum of squared
    distances to the centres.  An empty table gives no rows."""
    root, trees = bisecting_trees(features, ks, seed, max_iter)
    models, cost = {}, {}
    for k, splits in trees.items():
        leaves = _leaves(root, splits)
        cost[k] = sum(n.cost for n in leaves)
        if splits:
            at = {id(s): i for i, s in enumerate(splits)}
            models[k] = _layout(splits), np.array([2 * at[id(n.split)] + n.half for n in leaves])

    def labels(x, model):
        layout, leaves = model
        return _inside(x, layout)[leaves].argmax(axis=0)

    held = _held(features, models, labels) if models else {}
    score = silhouettes(features, models, labels) if models else {}
    return spark.createDataFrame([(k, held.get(k, 1), score.get(k), float(cost[k])) for k in trees],
                                 "k int, n_clusters int, silhouette double, cost double")


def _held(features: DataFrame, models: dict, labels) -> dict[int, int]:
    """Clusters that hold rows, per model."""
    def names(batches):
        seen = {k: set() for k in models}
        for x in _steps(batches, 2 * max(len(leaves) for _, leaves in models.values()), _PASS_STEP):
            for k, model in models.items():
                seen[k].update(np.unique(labels(x, model)).tolist())
        rows = [(k, c) for k, cs in seen.items() for c in sorted(cs)]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()), pa.array([c for _, c in rows], pa.int32())], names=["k", "c"])

    found = _dense(features).mapInArrow(names, "k int, c int").groupBy("k").agg(F.countDistinct("c").alias("n"))
    return {r.k: r.n for r in found.collect()}
