"""K-Means of many candidates at once, against Lloyd's rounds one by one and against silhouettes by definition."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from larder.operators import kmeans_sweep as K
from larder.operators import models as M


def _features(spark, x, parts=5):
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, x array<double>")
    return df.repartition(parts).select("id", array_to_vector("x").alias("features"))


def _groups(seed=1, n=60, width=4):
    rng = np.random.default_rng(seed)
    return np.vstack([rng.normal(0, 0.3, (n, width)) + 4 * np.eye(width)[g] * (1 + g) for g in range(3)])


def _lloyd(x, centers, rounds=300, tol=1e-4):
    for _ in range(rounds):
        near = ((x[:, None] - centers) ** 2).sum(axis=2).argmin(axis=1)
        moved = np.array([x[near == c].mean(axis=0) if (near == c).any() else centers[c] for c in range(len(centers))])
        step = np.sqrt(((moved - centers) ** 2).sum(axis=1)).max()
        centers = moved
        if step <= tol:
            break
    return centers, ((x[:, None] - centers) ** 2).sum(axis=2).min(axis=1).sum()


def _silhouette(x, labels):
    d = ((x[:, None] - x) ** 2).sum(axis=2)
    out = []
    for i, own in enumerate(labels):
        mine = labels == own
        if mine.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, mine].sum() / (mine.sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels) - {own})
        out.append((b - a) / max(a, b))
    return np.mean(out)


def test_all_starts_together_equal_each_alone(spark):
    x = np.vstack([_groups(), _groups()[:50]])  # repeated rows
    rng = np.random.default_rng(3)
    starts = [x[rng.choice(len(x), k, replace=False)] for k in (4, 2, 3, 2, 7, 3, 4)]
    starts.append(np.vstack([x[:2], np.full((1, 4), 1e3)]))  # a centre that never gets a row
    found = K.lloyd(_features(spark, x), starts)
    for start, (centers, inertia) in zip(starts, found, strict=True):
        want, cost = _lloyd(x, start)
        assert np.allclose(centers, want) and inertia == pytest.approx(cost)
    assert np.allclose(found[-1][0][2], 1e3)


def test_steps_of_one_row_give_the_same(spark, monkeypatch):
    x = _groups(n=8)
    whole = K.lloyd(_features(spark, x), [x[:3], x[5:7]])
    monkeypatch.setattr(K, "_STEP", 1)
    for (a, p), (b, q) in zip(whole, K.lloyd(_features(spark, x), [x[:3], x[5:7]]), strict=True):
        assert np.allclose(a, b) and p == pytest.approx(q)


def test_seed_points_do_not_grow_with_the_rows(spark):
    rng = np.random.default_rng(5)
    for n in (400, 4000):
        x = rng.normal(size=(n, 3))
        x[: n // 3] = x[0]  # a third of all rows are copies
        points, weights = K.seed_points(_features(spark, x), "id", per_round=20, rounds=4)
        near = ((x[:, None] - points) ** 2).sum(axis=2).argmin(axis=1)
        assert weights.sum() == n and sorted(weights) == sorted(np.bincount(near, minlength=len(points)))
        assert 40 <= len(points) <= 130


def test_sweep_finds_the_groups_and_scores_them(spark):
    x = _groups()
    feats = _features(spark, x)
    rows = {(r.k, r.run): r for r in K.kmeans_sweep(spark, feats, "id", range(2, 5), runs=2, n_init=3).collect()}
    assert set(rows) == {(k, run) for k in (2, 3, 4) for run in (0, 1)}
    truth = np.repeat([0, 1, 2], 60)
    cost = sum(((x[truth == g] - x[truth == g].mean(axis=0)) ** 2).sum() for g in range(3))
    for run in (0, 1):
        assert rows[3, run].inertia == pytest.approx(cost)
        assert rows[3, run].silhouette == pytest.approx(_silhouette(x, truth))
        assert rows[2, run].inertia > rows[3, run].inertia > rows[4, run].inertia
    best = {r.k: r for r in M.kmeans_analysis(spark, feats, "id", (2, 4), n_init_strategies=2, n_init=3).collect()}
    total = ((x - x.mean(axis=0)) ** 2).sum()
    assert best[3].calinski_harabasz == pytest.approx((total - cost) / 2 / (cost / (len(x) - 3)))
    assert best[3].stability == pytest.approx(0.0) and max(best.values(), key=lambda r: r.silhouette).k == 3


def test_equal_rows_and_no_rows(spark):
    same = _features(spark, np.ones((9, 2)))
    rows = K.kmeans_sweep(spark, same, "id", [2, 3], n_init=2).collect()
    assert [(r.k, r.silhouette, r.inertia) for r in sorted(rows)] == [(2, None, 0.0), (3, None, 0.0)]
    assert K.kmeans_sweep(spark, same.where(F.lit(False)), "id", [2, 3]).count() == 0


def test_a_pass_holds_few_distances_at_once():
    """Distances of a step stay in a core's cache however many starts share the pass."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(1)
    x = rng.integers(0, 3, (4000, 6)).astype(float)  # many rows lie equally far from two centres: the first one holds them
    starts = [x[rng.choice(len(x), k, replace=False)] for k in (7, 2, 5) for _ in range(60)]

    class Rows:
        def mapInArrow(self, sums, schema):
            values = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * 6, pa.int32()), pa.array(x.ravel()))
            tracemalloc.start()
            self.table, = sums([pa.RecordBatch.from_arrays([values], names=["x"])])
            self.peak = tracemalloc.get_traced_memory()[1]
            tracemalloc.stop()
            raise InterruptedError

    rows = Rows()
    with pytest.raises(InterruptedError):
        K._pass(rows, starts)
    assert rows.peak < 30_000_000
    found = {c: s for c, s in zip(*[rows.table.column(i).to_pylist() for i in (0, 1)], strict=True)}
    c = 0
    for start in sorted(starts, key=len):
        far = ((x[:, None] - start[None]) ** 2).sum(axis=2)
        near, cost = far.argmin(axis=1), far.min(axis=1).sum()
        for j in range(len(start)):
            mine = x[near == j]
            if len(mine):
                assert np.allclose(found[c], [cost, len(mine), *mine.sum(axis=0)])
                cost = 0.0
            else:
                assert c not in found
            c += 1


def test_rows_without_a_common_term_go_to_the_first_centre(spark):
    """Centres of length 1 but for rounding are as far as each other from such rows."""
    rng = np.random.default_rng(3)
    terms = rng.random((6, 5)) + 0.1
    start = np.hstack([terms / np.sqrt((terms * terms).sum(axis=1))[:, None], np.zeros((6, 4))])
    far = np.hstack([np.zeros((40, 5)), np.eye(4)[np.arange(40) % 4]])
    (held, cost), = K._pass(K._dense(_features(spark, far)), [start])
    assert held[:, 0].tolist() == [40, 0, 0, 0, 0, 0] and abs(cost - 80) < 1e-9
