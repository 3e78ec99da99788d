"""K-Means for many cluster counts, runs and starts at once.

Lloyd's rounds of all candidates share one pass over the rows: a task lays the
centres of all open candidates side by side, so the distances of a step are one
matrix product and the sums per centre another.  Spark adds the sums per centre,
and the driver sees one row per centre.  A candidate that has settled leaves the
pass.  The starts come from one oversampled set of points (k-means||), drawn and
weighted over all rows.

The cost of a pass is rows x centres x width, whatever the number of candidates
it is split into; a task holds one step of rows and one value per centre and
dimension.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators.mixtures import silhouettes

#: Distances that a step of a task holds at once (16 MB).
_STEP = 2_000_000

#: Those of a step of a pass, few enough to stay in a core's cache (3 MB).
_PASS_STEP = 400_000


def square_distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    out = (x * x).sum(axis=1)[:, None] + (centers * centers).sum(axis=1) - 2 * (x @ centers.T)
    return np.maximum(out, 0.0, out=out)


def _steps(batches, width: int, most: int = _STEP):
    for batch in batches:
        if batch.num_rows:
            rows = np.asarray(batch.column(0).flatten()).reshape(batch.num_rows, -1)
            step = max(1, most // width)
            for lo in range(0, len(rows), step):
                yield rows[lo:lo + step]


def _pass(dense: DataFrame, candidates: Sequence[np.ndarray]) -> list[tuple[np.ndarray, float]]:
    """Per candidate, in the given order: (rows and sums per centre, inertia)."""
    order = sorted(range(len(candidates)), key=lambda i: len(candidates[i]))
    sizes = [len(candidates[i]) for i in order]
    ends = np.cumsum(sizes)
    width = candidates[0].shape[1]
    # Candidates of one size are neighbours: (size, number of them, first centre, first candidate, centres, squares).  Their
    # first centres stand before their second ones, so nearest centres are compared over all rows and candidates at once.
    blocks, moves = [], np.empty(int(ends[-1]), dtype=int)
    for k in sorted(set(sizes)):
        many, candidate = sizes.count(k), sizes.index(k)
        first = int(ends[candidate]) - k
        near = np.stack([candidates[i] for i in order[candidate:candidate + many]], axis=1).reshape(k * many, width)
        blocks.append((k, many, first, candidate, -2 * near, (near * near).sum(axis=1)[:, None]))
        moves[first:first + k * many] = first + np.arange(k * many).reshape(k, many).T.ravel()
    widest = max(k * many for k, many, *_ in blocks)

    def sums(batches):
        total, cost = np.zeros((int(ends[-1]), width + 1)), np.zeros(len(sizes))
        for x in _steps(batches, widest, _PASS_STEP):
            rows, own = np.hstack([np.ones((len(x), 1)), x]), (x * x).sum(axis=1)
            for k, many, first, candidate, near, squares in blocks:
                # In this order, as in ``square_distances``: rows without a common term are as far from all centres of length 1.
                far = near @ x.T
                far += own + squares
                far = np.maximum(far, 0.0, out=far).reshape(k, many, len(x))
                least, nearest = far[0].copy(), np.zeros((many, len(x)), dtype=np.min_scalar_type(k))
                for j in range(1, k):
                    np.copyto(nearest, j, where=far[j] < least)
                    np.minimum(least, far[j], out=least)
                for j in range(k):
                    far[j] = nearest == j  # the distances have done their work
                total[first:first + k * many] += far.reshape(k * many, len(x)) @ rows
                cost[candidate:candidate + many] += least.sum(axis=1)
        total = total[moves]  # candidate by candidate
        held = np.flatnonzero(total[:, 0])
        if len(held):
            # The inertia of a candidate travels with its first centre that holds a row.
            owner = np.searchsorted(ends, held, side="right")
            lead = np.r_[True, owner[1:] != owner[:-1]]
            rows = np.hstack([np.where(lead, cost[owner], 0.0)[:, None], total[held]])
            values = pa.ListArray.from_arrays(pa.array(np.arange(len(held) + 1) * rows.shape[1], pa.int32()), pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), values], names=["c", "s"])

    parts = dense.mapInArrow(sums, "c int, s array<double>")
    added = parts.groupBy("c").agg(vector_to_array(Summarizer.sum(array_to_vector("s"))).alias("s")).toArrow()  # one row per centre
    table = np.zeros((int(ends[-1]), 2 + width))
    if added.num_rows:
        table[added["c"].to_numpy()] = np.asarray(added["s"].combine_chunks().flatten()).reshape(added.num_rows, -1)
    out = [None] * len(candidates)
    for i, end, size in zip(order, ends, sizes, strict=True):
        own = table[end - size:end]
        out[i] = own[:, 1:], float(own[:, 0].sum())
    return out


def _dense(features: DataFrame) -> DataFrame:
    return features.select(vector_to_array("features").alias("x"))


def _uniform(key: str, *salt: int) -> Column:
    """A draw in [0, 1) that depends on the key and the salt alone."""
    return F.pmod(F.xxhash64(F.col(key), *[F.lit(s) for s in salt]), F.lit(1 << 53)) / float(1 << 53)


def seed_points(features: DataFrame, key: str, per_round: int, rounds: int = 4, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """(points, rows nearest to each): about ``per_round * rounds`` rows, each
    round's drawn in proportion to the squared distance from the points so far.
    How many are drawn does not depend on the number of rows."""
    first = features.agg(F.min_by(vector_to_array("features"), F.struct(_uniform(key, seed), key)).alias("x")).first()["x"]
    if first is None:
        return np.empty((0, 0)), np.empty(0)
    points, dense = np.array([first]), _dense(features)
    (held, inertia), = _pass(dense, [points])
    for step in range(1, rounds + 1):
        if inertia <= 1e-12 * held[:, 0].sum():
            break
        rate, known = per_round / inertia, points

        def draw(batches):
            for batch in batches:
                if batch.num_rows:
                    x = np.asarray(batch.column(0).flatten()).reshape(batch.num_rows, -1)
                    size = max(1, _STEP // len(known))
                    far = np.concatenate([square_distances(x[lo:lo + size], known).min(axis=1) for lo in range(0, len(x), size)])
                    yield batch.filter(pa.array(np.asarray(batch.column(1)) < rate * far)).select([0])

        given = features.select(vector_to_array("features").alias("x"), _uniform(key, seed, step).alias("u"))
        drawn = [r.x for r in given.mapInArrow(draw, "x array<double>").collect()]  # per_round rows on average
        if drawn:
            points = np.unique(np.vstack([points, np.array(drawn)]), axis=0)
            (held, inertia), = _pass(dense, [points])
    return points, held[:, 0]


def draw_start(points: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++ on weighted points: ``k`` centres, fewer where there are fewer points."""
    rng = np.random.default_rng(seed)
    chance, far, chosen = weights.astype(float), np.full(len(points), np.inf), []
    while len(chosen) < k and chance.sum() > 0:
        at = int(rng.choice(len(points), p=chance / chance.sum()))
        chosen.append(at)
        far = np.minimum(far, ((points - points[at]) ** 2).sum(axis=1))
        far[at] = 0.0
        chance = weights * far
    return points[chosen]


def lloyd(features: DataFrame, starts: Sequence[np.ndarray], max_iter: int = 300, tol: float = 1e-4) -> list[tuple[np.ndarray, float]]:
    """(centres, inertia) of every start after at most ``max_iter`` rounds; a
    start has settled once no centre moves by more than ``tol``.  A centre
    without rows stays where it is."""
    dense, centers = _dense(features), [np.array(s, dtype=float) for s in starts]
    open_ = list(range(len(centers)))
    for _ in range(max_iter):
        if not open_:
            break
        still = []
        for i, (sums, _) in zip(open_, _pass(dense, [centers[i] for i in open_]), strict=True):
            moved = np.where(sums[:, :1] > 0, sums[:, 1:] / np.maximum(sums[:, :1], 1), centers[i])
            if np.sqrt(((moved - centers[i]) ** 2).sum(axis=1).max()) > tol:
                still.append(i)
            centers[i] = moved
        open_ = still
    return [(c, cost) for c, (_, cost) in zip(centers, _pass(dense, centers), strict=True)] if centers else []


def kmeans_sweep(spark: SparkSession, features: DataFrame, key: str, ks: Sequence[int], runs: int = 1, n_init: int = 10,
                 seed: int = 42, max_iter: int = 300) -> DataFrame:
    """(k, run, silhouette, inertia): for every k, ``runs`` runs, each the best
    of ``n_init`` starts by inertia.  The silhouette (squared Euclidean) is null
    where all rows are in one cluster.  An empty table gives no rows."""
    ks = list(ks)
    points, weights = seed_points(features, key, 4 * max(ks), seed=seed)
    names = [(k, run) for k in ks for run in range(runs) for _ in range(n_init)] if len(points) else []
    starts = [draw_start(points, weights, k, seed + i) for i, (k, _) in enumerate(names)]
    best = {}
    for name, (centers, inertia) in zip(names, lloyd(features, starts, max_iter), strict=True):
        if name not in best or inertia < best[name][1]:
            best[name] = centers, inertia
    kept = sorted(best)
    score = silhouettes(features, {i: best[name][0] for i, name in enumerate(kept)},
                        lambda x, centers: square_distances(x, centers).argmin(axis=1)) if kept else {}
    return spark.createDataFrame([(*name, score[i], best[name][1]) for i, name in enumerate(kept)],
                                 "k int, run int, silhouette double, inertia double")
