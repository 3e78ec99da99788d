"""Bisecting K-Means of many cluster counts at once, against Spark's fit of each count alone."""

import numpy as np
import pytest
from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector

from larder.operators import bisecting_sweep as B
from larder.operators import models as M


def _features(spark, x, parts=8):
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, x array<double>")
    return df.repartition(parts).select("id", array_to_vector("x").alias("features")).cache()


def _groups(groups, n=30, width=6, seed=1):
    rng = np.random.default_rng(seed)
    return np.vstack([rng.normal(0, 0.05, (n + g, width)) + 3 * rng.normal(size=width) for g in range(groups)])


def _alone(features, k, seed=42):
    m = BisectingKMeans(k=k, seed=seed, featuresCol="features").fit(features)
    out = m.transform(features)
    found = out.select("prediction").distinct().count()
    ev = ClusteringEvaluator(featuresCol="features", predictionCol="prediction")
    return found, ev.evaluate(out) if found > 1 else None, m.summary.trainingCost


def test_every_count_equals_its_own_fit(spark):
    features = _features(spark, _groups(12))
    got = {r.k: r for r in M.bisecting_analysis(spark, features, (2, 12)).collect()}
    assert sorted(got) == list(range(2, 13))
    for k in (3, 6, 11):
        found, silhouette, cost = _alone(features, k)
        assert got[k].n_clusters == found
        assert got[k].silhouette == pytest.approx(silhouette) and got[k].cost == pytest.approx(cost)


def test_few_different_rows_end_early(spark):
    x = np.repeat(np.eye(3), [5, 4, 1], axis=0)
    features = _features(spark, x, 3)
    got = {r.k: (r.n_clusters, r.silhouette, r.cost) for r in M.bisecting_analysis(spark, features, (2, 6)).collect()}
    for k in (2, 6):
        (found, silhouette, cost), want = got[k], _alone(features, k)
        assert found == want[0] and silhouette == pytest.approx(want[1]) and cost == pytest.approx(want[2], abs=1e-9)
    assert got[6][0] == 3
    same = M.bisecting_analysis(spark, _features(spark, np.ones((4, 2))), (2, 3)).collect()
    assert [(r.k, r.n_clusters, r.silhouette, r.cost) for r in same] == [(2, 1, None, 0.0), (3, 1, None, 0.0)]
    assert M.bisecting_analysis(spark, features.limit(0)).count() == 0


def test_counts_share_their_passes(spark, monkeypatch):
    passes, sums = [], B._sums
    monkeypatch.setattr(B, "_sums", lambda dense, splits, open_: passes.append(len(open_)) or sums(dense, splits, open_))
    _, trees = B.bisecting_trees(_features(spark, _groups(16)), range(2, 16))
    assert [len(trees[k]) for k in range(2, 16)] == list(range(1, 15))
    assert len(passes) <= 1 + 4 * 20  # of 14 fits by themselves: 45 levels of 20 rounds
    assert len({id(s) for splits in trees.values() for s in splits}) <= 42  # of 105
