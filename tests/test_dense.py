"""Dense vectors in blocks, mixtures, densities and in-category pairs against brute force."""

import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from larder.operators import blocks
from larder.operators.category_pairs import category_pairs
from larder.operators.cluster_metrics import points
from larder.operators.dense_index import build_index, exact_nearest, probes_for, recall, search, unit_rows
from larder.operators.density import density
from larder.operators.euclid import euclidean_silhouettes
from larder.operators.mixtures import log_densities, mixture_labels, mixture_sweep, silhouettes


def _frame(spark, x, labels=None):
    labels = labels if labels is not None else [0] * len(x)
    return spark.createDataFrame([(i, [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, labels, strict=True))],
                                 "id long, v array<double>, label int")


def test_every_query_meets_every_row_of_its_group_once(spark):
    rows = spark.range(300).select((F.col("id") % 3).cast("int").alias("g"), F.col("id").alias("k"),
                                   F.array(F.lit(1.0)).alias("x"), F.lit(0).cast("long").alias("extra"))
    dealt = blocks.deal(rows.where("k % 2 = 0"), rows.where("g < 2"), per_query=7, per_rows=30)
    pairs = {}
    for r in dealt.collect():
        pairs.setdefault((r.g, r.i, r.j), ([], []))[r.kind].append(r.k)
    assert max(len(q) for q, _ in pairs.values()) < 30
    met = [(a, b) for (q, w) in pairs.values() for a in q for b in w]
    assert len(met) == len(set(met)) == sum(1 for a in range(0, 300, 2) for b in range(300) if a % 3 == b % 3 < 2)


@pytest.mark.parametrize("small_cells", [False, True])
def test_euclidean_silhouette(spark, monkeypatch, small_cells):
    if small_cells:
        import larder.operators.blocks as B
        monkeypatch.setattr(B.deal, "__defaults__", (5, 11, None))
    rng = np.random.default_rng(1)
    x = rng.normal(size=(90, 4))
    x[10] = x[11] = x[12]
    labels = [*(rng.integers(0, 4, 88)), 7, 4]
    pts = points(_frame(spark, x, labels), "id", "v", "label")
    got = {r["key"]: r["silhouette"] for r in euclidean_silhouettes(pts, pts.where("key % 3 = 0 or key > 87")).collect()}
    labels = np.array(labels)
    for i in got:
        far = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        own = labels == labels[i]
        if own.sum() == 1:
            assert got[i] == 0
            continue
        a = far[own].sum() / (own.sum() - 1)
        b = min(far[labels == c].mean() for c in set(labels) - {labels[i]})
        assert math.isclose(got[i], (b - a) / max(a, b), abs_tol=1e-10)
    assert len(got) == 32


def test_silhouette_without_rows_or_other_clusters(spark):
    pts = points(_frame(spark, [[0.0], [1.0], [0.0]]), "id", "v", "label")
    assert {r["silhouette"] for r in euclidean_silhouettes(pts, pts).collect()} == {0.0}
    assert euclidean_silhouettes(pts.where("false"), pts.where("false")).collect() == []


def test_index_recall_and_exact_neighbours(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    x = centres[rng.integers(0, 12, 900)] + 0.3 * rng.normal(size=(900, 16))
    x[5] = 0
    x[8] = x[9] = x[7]
    rows = unit_rows(_frame(spark, x), "id", "v").cache()
    asked = rows.where("k % 10 = 0 or k in (7, 8)")
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    exact = exact_nearest(rows, asked, 5).cache()
    got = {}
    for r in exact.collect():
        got.setdefault(r["a"], {})[r["rank"]] = r["b"]
    assert 5 not in got and got[7][1] == 8 and got[8][1] == 7
    for a, mine in got.items():
        sims = np.round(unit @ unit[a], 9)
        best = sorted((b for b in range(900) if b not in (a, 5)), key=lambda b: (-sims[b], b))[:5]
        assert [mine[r] for r in range(1, 6)] == best
    index = build_index(rows, lists=20)
    assert index.rows.count() == rows.count() == 899
    assert probes_for(index, rows, 5) < 20
    share = recall(search(index, rows, asked, 5), exact).first()
    assert share["queries"] == len(got) and share["recall"] >= 0.9
    # With every list read only the codes' rounding is left.
    assert recall(search(index, rows, asked, 5, probes=20), exact).first()["recall"] >= 0.999


def test_vectors_without_direction(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, None), (3, []), (None, [1.0, 0.0])], "id long, v array<double>")
    rows = unit_rows(df, "id", "v")
    assert rows.collect() == [] and exact_nearest(rows, rows).collect() == []


@pytest.mark.parametrize("kind", ["full", "tied", "diag", "spherical"])
def test_mixtures_equal_plain_em(spark, kind):
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal((0, 0), (1, 0.4), (60, 2)), rng.normal((6, 5), (0.5, 1.2), (40, 2))])
    df = spark.createDataFrame([(i, Vectors.dense(r)) for i, r in enumerate(x)], ["id", "features"]).repartition(3)
    starts = {k: x[rng.choice(100, k, replace=False)] for k in (2, 3)}
    models = mixture_sweep(df, [2, 3], kind, max_iter=12, tol=0.0, starts=starts)
    for k, m in models.items():
        means, weights = starts[k], np.full(k, 1 / k)
        cov = np.repeat(np.cov(x.T, bias=True)[None], k, axis=0)
        for _ in range(12):
            factors = np.array([np.linalg.inv(np.linalg.cholesky(c + 1e-6 * np.eye(2))) for c in cov])
            log_p = log_densities(x, means, factors) + np.log(weights)
            norm = np.logaddexp.reduce(log_p, axis=1)
            r = np.exp(log_p - norm[:, None])
            weights, means = r.mean(axis=0), (r.T @ x) / r.sum(axis=0)[:, None]
            parts = np.array([((x - means[c]).T * r[:, c]) @ (x - means[c]) for c in range(k)])
            own = parts / r.sum(axis=0)[:, None, None]
            cov = {"full": own, "tied": np.repeat(parts.sum(axis=0)[None] / 100, k, axis=0), "diag": own * np.eye(2),
                   "spherical": np.array([np.trace(c) / 2 * np.eye(2) for c in own])}[kind]
        assert np.allclose(m["means"], means, atol=1e-6) and np.allclose(m["covariances"], cov, atol=1e-6)
        assert math.isclose(m["log_likelihood"], norm.sum(), abs_tol=1e-6)
    assert models[2]["parameters"] == 4 + {"full": 6, "tied": 3, "diag": 4, "spherical": 2}[kind] + 1
    best = log_densities(x, models[2]["means"], models[2]["factors"]) + np.log(models[2]["weights"])
    assert {r["id"]: r["prediction"] for r in mixture_labels(df, models[2]).collect()} == dict(enumerate(best.argmax(axis=1)))
    from pyspark.ml.evaluation import ClusteringEvaluator
    by_spark = ClusteringEvaluator().evaluate(mixture_labels(df, models[2]))
    assert math.isclose(silhouettes(df, models)[2], by_spark, abs_tol=1e-9)


def test_density_is_near_the_exact_curve(spark):
    rng = np.random.default_rng(5)
    values = {"a": rng.normal(3, 2, 500), "b": np.repeat([1.0, 2.0, 7.0], 30), "one": [4.0], "same": [2.0, 2.0]}
    rows = [(g, float(v)) for g, vs in values.items() for v in vs] + [(None, 1.0), ("a", None)]
    got = {}
    for r in density(spark.createDataFrame(rows, "g string, v double"), "g", "v").collect():
        got.setdefault(r["g"], []).append((r["x"], r["density"]))
    assert set(got) == {"a", "b"}
    for g, curve in got.items():
        v = np.array(values[g])
        h = v.std(ddof=1) * len(v) ** -0.2
        at, found = np.array(sorted(curve)).T
        exact = np.exp(-0.5 * ((at[:, None] - v) / h) ** 2).sum(axis=1) / (len(v) * h * math.sqrt(2 * math.pi))
        assert len(at) == 100 and np.isclose(at[0], v.min() - 2 * h) and np.abs(found - exact).max() < 1e-3 * exact.max()


@pytest.mark.parametrize("sizes", [(1, 2, 3), (4, 7, 90), (101, 2, 1)])
def test_pair_draws_are_distinct(spark, sizes):
    rows = [(100 * c + i, f"c{c}") for c, n in enumerate(sizes) for i in range(n)] + [(9_999, None)]
    df = spark.createDataFrame(rows, "code long, category_searched string")
    every = [(r["product1"], r["product2"]) for r in category_pairs(df, None).collect()]
    assert sorted(every) == [(a, b) for a, x in rows for b, y in rows if x == y and x is not None and a < b]
    few = category_pairs(df, 3, max_pairs=50).collect()
    for c, n in enumerate(sizes):
        mine = [r for r in few if r["category"] == f"c{c}"]
        assert len(mine) == min(n * (n - 1) // 2, 3 * n, 50) == len({(r["product1"], r["product2"]) for r in mine})
        assert sorted(r["pair"] for r in mine) == list(range(len(mine)))


def test_pair_draws_are_spread_evenly(spark):
    df = spark.range(60).select(F.col("id").alias("code"), F.lit("c").alias("category_searched"))
    drawn = category_pairs(df, 10).collect()  # 600 of 1,770
    seen = np.bincount([r[c] for r in drawn for c in ("product1", "product2")], minlength=60)
    assert 8 <= seen.min() and seen.max() <= 34
