"""Gaussian mixtures of four covariance types, for many component counts at once.

Every round is one pass over the rows, whatever the number of candidates: a
task sums weights, weighted rows and (full) weighted outer products of each
component of each candidate, and the sums are added per component by Spark.
The driver sees one row per component.  Labels and silhouettes of all candidates
take two more passes.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Covariance types, and the second moments that a round of each sums per component.
KINDS = {"full": "outer", "tied": "", "diag": "squares", "spherical": "squares"}
#: Rows of one matrix step in a task.
_STEP = 2_048


def log_densities(x: np.ndarray, means: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Rows x components; ``factors`` are the inverses of the covariances' Cholesky factors."""
    out = np.empty((len(x), len(means)))
    for c, (mean, inverse) in enumerate(zip(means, factors, strict=True)):
        z = (x - mean) @ inverse.T
        out[:, c] = np.log(np.abs(np.diag(inverse))).sum() - 0.5 * (z * z).sum(axis=1)
    return out - 0.5 * x.shape[1] * math.log(2 * math.pi)


def _weighted(x, model):
    return log_densities(x, model["means"], model["factors"]) + np.log(np.maximum(model["weights"], 1e-300))


def _factors(covariances: np.ndarray, ridge: float) -> np.ndarray:
    d = covariances.shape[1]
    return np.array([np.linalg.inv(np.linalg.cholesky((c + c.T) / 2 + ridge * np.eye(d))) for c in covariances])


def _pass(dense: DataFrame, models: dict[int, dict], moments: str = "") -> dict[int, tuple[np.ndarray, float]]:
    """Per candidate k: (k x (1 + d [+ moments]) sums, log-likelihood), where
    ``moments`` may be 'outer' products (d * d) or 'squares' (d)."""
    def sums(batches):
        held = {k: [0.0, 0.0] for k in models}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            whole = np.asarray(batch.column(0).flatten()).reshape(batch.num_rows, -1)
            for lo in range(0, len(whole), _STEP):
                x = whole[lo:lo + _STEP]
                for k, model in models.items():
                    log_p = _weighted(x, model)
                    top = log_p.max(axis=1, keepdims=True)
                    norm = top[:, 0] + np.log(np.exp(log_p - top).sum(axis=1))
                    r = np.exp(log_p - norm[:, None])
                    parts = [r.sum(axis=0)[:, None], r.T @ x]
                    if moments == "squares":
                        parts.append(r.T @ (x * x))
                    if moments == "outer":
                        parts.append(np.array([((x * r[:, c:c + 1]).T @ x).ravel() for c in range(k)]))
                    held[k][0] = held[k][0] + np.hstack(parts)
                    held[k][1] += float(norm.sum())
        for k, (total, ll) in held.items():
            if isinstance(total, np.ndarray):
                for c in range(k):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k], pa.int32()), pa.array([c], pa.int32()), pa.array([total[c].tolist()], pa.list_(pa.float64())),
                         pa.array([ll if c == 0 else 0.0])], names=["k", "c", "s", "ll"])

    parts = dense.mapInArrow(sums, "k int, c int, s array<double>, ll double")
    rows = parts.groupBy("k", "c").agg(vector_to_array(Summarizer.sum(array_to_vector("s"))).alias("s"), F.sum("ll").alias("ll")).collect()
    out = {}
    for k in models:
        mine = sorted((r for r in rows if r.k == k), key=lambda r: r.c)
        out[k] = np.array([r.s for r in mine]), sum(r.ll for r in mine)
    return out


def mixture_sweep(features: DataFrame, ks: Sequence[int], kind: str = "full", seed: int = 42, max_iter: int = 30, tol: float = 1e-3,
                  ridge: float = 1e-6, starts: dict[int, np.ndarray] | None = None) -> dict[int, dict]:
    """EM for every k of ``ks``, of a ``kind`` of ``KINDS``.

    Starts from K-Means centres (or ``starts``) and the covariance of all rows;
    a candidate ends when its mean log-likelihood gains less than ``tol``.
    ``ridge`` is added to the diagonals, so no fit is singular."""
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {', '.join(KINDS)}")
    dense = features.select(vector_to_array("features").alias("x"))
    if starts is None:
        starts = kmeans_starts(features, ks, seed)
    d = next(iter(starts.values())).shape[1]
    one = {1: {"means": np.zeros((1, d)), "factors": np.eye(d)[None], "weights": np.ones(1)}}
    total = _pass(dense, one, "outer")[1][0][0]
    n, mean, scatter = total[0], total[1:1 + d] / total[0], total[1 + d:].reshape(d, d)
    spread = scatter / n - np.outer(mean, mean)
    models = {k: {"means": starts[k], "weights": np.full(k, 1 / k), "covariances": np.repeat(spread[None], k, axis=0)} for k in ks}
    for m in models.values():
        m["factors"] = _factors(m["covariances"], ridge)
    open_, before = set(ks), dict.fromkeys(ks, -math.inf)
    for _ in range(max_iter):
        if not open_:
            break
        for k, (sums, ll) in _pass(dense, {k: models[k] for k in open_}, KINDS[kind]).items():
            m, mass = models[k], np.maximum(sums[:, :1], 1e-12)
            means = sums[:, 1:1 + d] / mass
            if kind == "full":
                second = sums[:, 1 + d:].reshape(k, d, d) / mass[:, :, None]
                covariances = second - means[:, :, None] * means[:, None, :]
            elif kind in ("diag", "spherical"):
                variances = np.maximum(sums[:, 1 + d:] / mass - means ** 2, 0.0)
                if kind == "spherical":
                    variances = np.repeat(variances.mean(axis=1, keepdims=True), d, axis=1)
                covariances = variances[:, :, None] * np.eye(d)
            else:
                # Responsibilities of a row sum to 1, so the raw second moments never change.
                shared = (scatter - (means * mass).T @ means) / n
                covariances = np.repeat(shared[None], k, axis=0)
            m.update(weights=sums[:, 0] / n, means=means, covariances=covariances, factors=_factors(covariances, ridge),
                     log_likelihood=float(ll), n=int(round(n)))
            if ll / n - before[k] < tol:
                open_.discard(k)
            before[k] = ll / n
    for k, m in models.items():
        shape = {"full": k * d * (d + 1) // 2, "tied": d * (d + 1) // 2, "diag": k * d, "spherical": k}[kind]
        m["parameters"] = k * d + shape + k - 1
    return models


def kmeans_starts(features: DataFrame, ks: Sequence[int], seed: int = 42) -> dict[int, np.ndarray]:
    return {k: np.array(KMeans(k=k, seed=seed, featuresCol="features").fit(features).clusterCenters()) for k in ks}


def mixture_labels(features: DataFrame, model: dict) -> DataFrame:
    """``features`` with the likeliest component as ``prediction``."""
    def label(x: pd.Series) -> pd.Series:
        rows = np.stack(x.to_list()) if len(x) else np.empty((0, model["means"].shape[1]))
        return pd.Series(_weighted(rows, model).argmax(axis=1).astype("int32"))
    return features.withColumn("prediction", F.pandas_udf(label, "int")(vector_to_array("features")))


def _likeliest(x: np.ndarray, model: dict) -> np.ndarray:
    return _weighted(x, model).argmax(axis=1)


def silhouettes(features: DataFrame, models: dict[int, object], assign=_likeliest) -> dict[int, float | None]:
    """Mean silhouette (squared Euclidean) of the clusters that ``assign(rows,
    model)`` gives (the likeliest components), for every candidate; None where
    one cluster takes all rows."""
    dense = features.select(vector_to_array("features").alias("x"))

    def steps(batches):
        for batch in batches:
            if batch.num_rows:
                whole = np.asarray(batch.column(0).flatten()).reshape(batch.num_rows, -1)
                for lo in range(0, len(whole), _STEP):
                    yield whole[lo:lo + _STEP]

    def summaries(batches):
        for x in steps(batches):
            for k, model in models.items():
                labels = assign(x, model)
                for c in np.unique(labels):
                    mine = x[labels == c]
                    sums = np.concatenate([[len(mine), (mine * mine).sum()], mine.sum(axis=0)])
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([int(c)], pa.int32()),
                                                      pa.array([sums.tolist()], pa.list_(pa.float64()))], names=["k", "c", "s"])

    parts = dense.mapInArrow(summaries, "k int, c int, s array<double>")
    rows = parts.groupBy("k", "c").agg(vector_to_array(Summarizer.sum(array_to_vector("s"))).alias("s")).collect()
    held = {k: {r.c: np.array(r.s) for r in rows if r.k == k} for k in models}  # one row per component

    def scores(batches):
        total = {k: [0.0, 0] for k in models}
        for x in steps(batches):
            for k, model in models.items():
                names = np.array(sorted(held[k]))
                if len(names) < 2:
                    continue
                s = np.array([held[k][c] for c in names])
                own = np.searchsorted(names, assign(x, model))
                far = (x * x).sum(axis=1)[:, None] + s[:, 1] / s[:, 0] - 2 * (x @ s[:, 2:].T) / s[:, 0]
                at, n = np.arange(len(x)), s[own, 0]
                a = far[at, own] * n / np.maximum(n - 1, 1)
                far[at, own] = np.inf
                b = far.min(axis=1)
                top = np.maximum(a, b)
                total[k][0] += float(np.where((n > 1) & (top > 0), (b - a) / np.where(top > 0, top, 1), 0.0).sum())
                total[k][1] += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([t for t, _ in total.values()], pa.float64()),
                                          pa.array([n for _, n in total.values()], pa.int64())], names=["k", "total", "n"])

    means = dense.mapInArrow(scores, "k int, total double, n long").groupBy("k").agg((F.sum("total") / F.nullif(F.sum("n"), F.lit(0))).alias("s"))
    found = {r.k: r.s for r in means.collect()}
    return {k: found.get(k) for k in models}


def sweep_table(spark: SparkSession, features: DataFrame, kind: str, models: dict[int, dict]) -> DataFrame:
    """One row per candidate, in the columns of ``models.gmm_selection``."""
    rows, score = [], silhouettes(features, models)
    for k, m in sorted(models.items()):
        ll, free, n = m["log_likelihood"], m["parameters"], m["n"]
        rows.append((kind, k, score[k], ll, -2 * ll + free * math.log(n), -2 * ll + 2 * free, ll / n, "ok"))
    return spark.createDataFrame(rows, "covariance string, n_components int, silhouette double, log_likelihood double, "
                                       "bic double, aic double, mean_log_likelihood double, status string")
