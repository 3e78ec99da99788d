"""Fitted models (C1-C3, C6, C11, C15, V4, V5, V7, E2-E5, S11) on Spark ML.

Features are built JVM-side and sparse: the relational vocabulary (bounded
by ``max_features``) feeds a ``CountVectorizerModel``, the smooth idf is an
``ElementwiseProduct`` and rows are L2-normalised — the same TF-IDF as
``operators.tfidf``.  Fits are distributed Spark ML jobs on a cached feature
table; restarts and parameter grids are loops over parameter values, each
iteration one Spark job, with results returned as DataFrames.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import IllegalArgumentException, SparkRuntimeException
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import (CountVectorizerModel, ElementwiseProduct, Normalizer, PCA,
                                VectorAssembler, Word2Vec)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.operators.cluster_metrics import adjusted_rand_index
from larder.operators.aggregates import attach_one_row
from larder.operators.bisecting_sweep import bisecting_sweep
from larder.operators.dense_index import exact_nearest
from larder.operators.kmeans_sweep import kmeans_sweep
from larder.operators.positions import position_index
from larder.operators.tfidf import english_stop_words, fit_vocabulary, kept_tokens, term_counts, with_ngrams
from larder.session import cut_lineage

MAX_VOCAB_FOR_VECTORS = 100_000


def tfidf_vectors(docs: DataFrame, key: str, text: str, max_df=1.0, min_df=1, max_features: int = 1000,
                  stop_words: Iterable[str] | None = None, ngram_range=(1, 1)) -> tuple[DataFrame, list[str]]:
    """(key, features SparseVector) and the term list (feature index order).

    The vocabulary is fitted relationally; only the kept terms and their idf
    (at most ``max_features`` values) reach the driver to parameterise the
    JVM transformers."""
    if not max_features or max_features > MAX_VOCAB_FOR_VECTORS:
        raise ValueError("vector features need a bounded vocabulary (max_features)")
    tf = term_counts(docs, key, text, ngram_range, stop_words)
    n_docs = docs.agg(F.count(F.lit(1)).cast("long").alias("n"))
    vocab = fit_vocabulary(tf, n_docs, key, max_df, min_df, max_features).orderBy("idx").collect()
    terms = [r["term"] for r in vocab]
    idf = Vectors.dense([r["idf"] for r in vocab])
    tokd = docs.select(key, with_ngrams(kept_tokens(text, stop_words), ngram_range).alias("tokens"))
    cv = CountVectorizerModel.from_vocabulary(terms, inputCol="tokens", outputCol="tf")
    ew = ElementwiseProduct(scalingVec=idf, inputCol="tf", outputCol="w")
    norm = Normalizer(p=2.0, inputCol="w", outputCol="features")
    out = norm.transform(ew.transform(cv.transform(tokd))).select(key, "features")
    return out, terms


def kmeans_best_of(features: DataFrame, k: int, seed: int = 42, n_init: int = 10, max_iter: int = 300):
    """K-Means with ``n_init`` restarts (seeds seed..seed+n_init-1);
    keeps the model with the lowest training cost (inertia)."""
    best = None
    for s in range(seed, seed + n_init):
        m = KMeans(k=k, seed=s, maxIter=max_iter, featuresCol="features").fit(features)
        if best is None or m.summary.trainingCost < best.summary.trainingCost:
            best = m
    return best


def centers_top_terms(spark: SparkSession, model, terms: Sequence[str], n_terms: int = 10) -> DataFrame:
    """Top ``n_terms`` terms per cluster by centroid weight (the k
    centres are already on the driver inside the fitted model)."""
    rows = [(int(c), terms[i], float(v)) for c, center in enumerate(model.clusterCenters())
            for i, v in enumerate(center)]
    df = spark.createDataFrame(rows, "cluster int, term string, weight double")
    w = Window.partitionBy("cluster").orderBy(F.desc("weight"), F.asc("term"))
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n_terms)


def pca_2d(features: DataFrame, key: str, k: int = 2) -> tuple[DataFrame, list[float]]:
    """V5: project on the top ``k`` principal components of the centred data;
    returns coordinates and the explained-variance ratios.  Spark's PCA works
    on the covariance, which does not depend on centring, so sparse rows stay
    sparse: they are projected as they are and the projected mean is
    subtracted."""
    model = PCA(k=k, inputCol="features", outputCol="pc").fit(features)
    mean = features.agg(Summarizer.mean(F.col("features")).alias("m")).first()["m"]
    shift = model.pc.toArray().T @ mean.toArray() if mean is not None else [0.0] * k
    out = model.transform(features).select(key, vector_to_array("pc").alias("pc"))
    cols = [(F.col("pc")[i] - F.lit(float(shift[i]))).alias(n) for i, n in enumerate(["pca_x", "pca_y", "pca_z"][:k])]
    return out.select(key, *cols), list(model.explainedVariance.toArray())


def run_clustering(spark: SparkSession, docs: DataFrame, key: str, text: str, k: int = 5, seed: int = 42,
                   n_init: int = 10) -> dict:
    """C1 (``run_clustering``): TF-IDF (Spark's English stop words, max_df 0.5,
    1000 features) -> best-of-``n_init`` K-Means -> labels, top terms, PCA, inertia."""
    feats, terms = tfidf_vectors(docs, key, text, max_df=0.5, max_features=1000, stop_words=english_stop_words())
    feats = cut_lineage(feats)
    model = kmeans_best_of(feats, k, seed, n_init)
    labels = model.transform(feats).select(key, F.col("prediction").alias("cluster"))
    coords, ratio = pca_2d(feats, key)
    return {"features": feats, "model": model, "labels": labels.join(coords, key),
            "terms": centers_top_terms(spark, model, terms), "inertia": model.summary.trainingCost,
            "explained_variance": ratio}


def _total_spread(features: DataFrame) -> tuple[int, float]:
    """Rows, and the sum of squared distances to their mean."""
    row = features.agg(Summarizer.metrics("count", "variance").summary(F.col("features")).alias("s")).first()["s"]
    return row["count"], float(sum(row["variance"].toArray())) * max(row["count"] - 1, 0)


def kmeans_analysis(spark: SparkSession, features: DataFrame, key: str, k_range=(2, 15), n_init_strategies: int = 5,
                    n_init: int = 10, max_iter: int = 300, seed: int = 42) -> DataFrame:
    """For each k of the inclusive range, ``n_init_strategies`` runs,
    each the best of ``n_init`` starts by inertia.  Per k: silhouette (squared
    Euclidean), Calinski-Harabasz and inertia of the run with the best
    silhouette, and the population std of the runs' silhouettes ("stability").
    All starts of all k share their passes (``kmeans_sweep``).
    Calinski-Harabasz follows from the inertia and the total spread, so it
    costs no pass."""
    n, spread = _total_spread(features)
    runs = kmeans_sweep(spark, features, key, range(k_range[0], k_range[1] + 1), n_init_strategies, n_init, seed, max_iter)
    ch = (F.lit(spread) - F.col("inertia")) / (F.col("k") - 1) / (F.col("inertia") / (F.lit(n) - F.col("k")))
    ch = F.when((F.lit(n) > F.col("k")) & (F.col("inertia") > 0) & (F.col("k") > 1), ch)
    return best_runs(runs.withColumn("calinski_harabasz", ch))


def best_runs(runs: DataFrame) -> DataFrame:
    """Per k, the run with the best silhouette (ties: the first), and the
    stability over all its runs."""
    best = F.max_by(F.struct("silhouette", "calinski_harabasz", "inertia"), F.struct("silhouette", -F.col("run"))).alias("b")
    return runs.groupBy("k").agg(best, F.stddev_pop("silhouette").alias("stability")).select("k", "b.*", "stability")


def bisecting_analysis(spark: SparkSession, features: DataFrame, k_range=(2, 15), seed: int = 42) -> DataFrame:
    """Divisive hierarchical clustering (bisecting K-Means, not agglomeration):
    silhouette and cost for each k of the inclusive range.  The splits of all k
    share their passes (``bisecting_sweep``)."""
    return bisecting_sweep(spark, features, range(k_range[0], k_range[1] + 1), seed)


def bisecting_labels(features: DataFrame, key: str, k: int, seed: int = 42) -> DataFrame:
    m = BisectingKMeans(k=k, seed=seed, featuresCol="features").fit(features)
    return m.transform(features).select(key, F.col("prediction").alias("cluster"))


COVARIANCES = ("full", "diag", "spherical")


def _information(ll: float, p: float, n: int) -> tuple[float, float]:
    return -2 * ll + p * math.log(n), -2 * ll + 2 * p


def diagonal_mixture(features: DataFrame, k: int, spherical: bool = False, seed: int = 42, max_iter: int = 30,
                     tol: float = 1e-3, floor: float = 1e-6) -> dict:
    """EM for a Gaussian mixture with diagonal (or spherical) covariances.

    Every round is one pass: a task sums weights, weighted values and weighted
    squares of its rows per component (k x (2d + 1) numbers), and the driver
    merges one such table per task.  Starts from K-Means centres; ends when
    the mean log-likelihood gains less than ``tol``."""
    start = KMeans(k=k, seed=seed, featuresCol="features").fit(features)
    means = np.array(start.clusterCenters())
    n, spread = _total_spread(features)
    d = means.shape[1]
    variances = np.full((k, d), max(spread / max(n * d, 1), floor))
    weights = np.full(k, 1 / k)
    dense = features.select(vector_to_array("features").alias("x"))
    before = -math.inf
    for _ in range(max_iter):
        def sums(batches, means=means, variances=variances, weights=weights):
            total, ll = np.zeros((k, 2 * d + 1)), 0.0
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                x = np.asarray(batch.column(0).flatten()).reshape(batch.num_rows, d)
                log_p = _log_density(x, means, variances) + np.log(np.maximum(weights, 1e-300))
                top = log_p.max(axis=1, keepdims=True)
                norm = top[:, 0] + np.log(np.exp(log_p - top).sum(axis=1))
                r = np.exp(log_p - norm[:, None])
                total += np.hstack([r.sum(axis=0)[:, None], r.T @ x, r.T @ (x * x)])
                ll += norm.sum()
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()]), pa.array([ll])], names=["s", "ll"])
        parts = dense.mapInArrow(sums, "s array<double>, ll double").collect()
        total = np.sum([p.s for p in parts], axis=0).reshape(k, 2 * d + 1)
        ll = sum(p.ll for p in parts)
        mass = np.maximum(total[:, :1], 1e-12)
        weights, means = total[:, 0] / n, total[:, 1:d + 1] / mass
        variances = np.maximum(total[:, d + 1:] / mass - means ** 2, floor)
        if spherical:
            variances = np.repeat(variances.mean(axis=1, keepdims=True), d, axis=1)
        if ll / n - before < tol:
            break
        before = ll / n
    free = k * d + (k if spherical else k * d) + (k - 1)
    return {"means": means, "variances": variances, "weights": weights, "log_likelihood": float(ll), "parameters": free, "n": n}


def _log_density(x, means, variances):
    """Row x component log densities; squares are expanded to matrix products."""
    inverse = 1 / variances
    far = (x * x) @ inverse.T - 2 * x @ (means * inverse).T + (means ** 2 * inverse).sum(axis=1)
    return -0.5 * (far + np.log(2 * np.pi * variances).sum(axis=1))


def diagonal_labels(features: DataFrame, mixture: dict) -> DataFrame:
    """``features`` with the likeliest component as ``prediction``."""
    def label(x: pd.Series) -> pd.Series:
        rows = np.stack(x.to_list()) if len(x) else np.empty((0, mixture["means"].shape[1]))
        log_p = _log_density(rows, mixture["means"], mixture["variances"]) + np.log(np.maximum(mixture["weights"], 1e-300))
        return pd.Series(log_p.argmax(axis=1).astype("int32"))
    return features.withColumn("prediction", F.pandas_udf(label, "int")(vector_to_array("features")))


def gmm_selection(spark: SparkSession, features: DataFrame, n_range=(2, 15), covariances: Sequence[str] = COVARIANCES,
                  seed: int = 42) -> DataFrame:
    """Gaussian mixtures for each covariance type and component count of
    the inclusive range, with silhouette, log-likelihood, BIC and AIC.  A full
    fit needs more rows per component than dimensions; where Spark refuses it
    as singular the row says so.  Tied covariances are not offered."""
    ev = ClusteringEvaluator(featuresCol="features", predictionCol="prediction")
    n = features.count()
    d = len(features.first()["features"])
    rows = []
    for kind in covariances:
        for k in range(n_range[0], n_range[1] + 1):
            if kind == "full":
                free = k * d + k * d * (d + 1) / 2 + (k - 1)
                try:
                    m = GaussianMixture(k=k, seed=seed, featuresCol="features").fit(features)
                except (Py4JJavaError, IllegalArgumentException, SparkRuntimeException) as e:
                    if "ingular" not in str(e) and "NotConverged" not in str(e) and "Matrix" not in str(e):
                        raise
                    rows.append((kind, k, None, None, None, None, None, "singular"))
                    continue
                ll, out = float(m.summary.logLikelihood), m.transform(features)
            else:
                m = diagonal_mixture(features, k, kind == "spherical", seed)
                ll, free, out = m["log_likelihood"], m["parameters"], diagonal_labels(features, m)
            bic, aic = _information(ll, free, n)
            silhouette = float(ev.evaluate(out)) if out.select("prediction").distinct().count() > 1 else None
            rows.append((kind, k, silhouette, ll, bic, aic, ll / n, "ok"))
    return spark.createDataFrame(rows, "covariance string, n_components int, silhouette double, log_likelihood double, "
                                       "bic double, aic double, mean_log_likelihood double, status string")


def bootstrap_stability(spark: SparkSession, features: DataFrame, key: str, k: int, n_boot: int = 10,
                        frac: float = 0.8, seed: int = 42) -> DataFrame:
    """C11: ``n_boot`` subsamples (hash-ordered Bernoulli, ``frac`` of rows,
    partition-independent), refit, ARI against the base labels."""
    base = KMeans(k=k, seed=seed, featuresCol="features").fit(features)
    base_lab = base.transform(features).select(key, F.col("prediction").alias("base"))
    out = None
    for b in range(n_boot):
        u = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|{b}|"), F.col(key).cast("string"))), 1, 8), 16, 10) \
            .cast("double") / float(16 ** 8)
        sub = features.where(u < frac)
        m = KMeans(k=k, seed=seed + b + 1, featuresCol="features").fit(sub)
        lab = m.transform(sub).select(key, F.col("prediction").alias("boot")).join(base_lab, key)
        ari = adjusted_rand_index(lab, "base", "boot").withColumn("bootstrap", F.lit(b))
        out = ari if out is None else out.unionByName(ari)
    return out


def combined_features(df: DataFrame, text_features: str, numeric_cols: Sequence[str]) -> DataFrame:
    """V4: text features + standardised numeric columns (text only when none
    of the numeric columns exist)."""
    present = [c for c in numeric_cols if c in df.columns]
    if not present:
        return df.withColumnRenamed(text_features, "combined")
    return VectorAssembler(inputCols=[text_features, *present], outputCol="combined").transform(df)


#: Sequences that one task of a Word2Vec fit works on.
SEQUENCES_PER_TASK = 20_000


def train_embeddings(sequences: DataFrame, vector_size: int = 100, window: int = 5, min_count: int = 2,
                     max_iter: int = 100, seed: int = 42):
    """Skip-gram word vectors over ingredient sequences; the number of
    tasks grows with the sequences."""
    tasks = max(1, math.ceil(sequences.count() / SEQUENCES_PER_TASK))
    return Word2Vec(vectorSize=vector_size, windowSize=window, minCount=min_count, maxIter=max_iter, numPartitions=tasks,
                    seed=seed, inputCol="sequence", outputCol="vec").fit(sequences)


def embedding_of(vectors: DataFrame, words: DataFrame, size: int, word_col: str = "word") -> DataFrame:
    """The vector of each word, a zero vector for unknown words."""
    zero = F.array_repeat(F.lit(0.0), size)
    found = vectors.select(word_col, F.col("vector").alias("_v"))
    return words.join(found, word_col, "left").select(word_col, F.coalesce(F.col("_v"), zero).alias("vector"))


def unit_vectors(vectors: DataFrame, word_col: str = "word") -> DataFrame:
    """(word, unit) of every vector that is not zero."""
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    scaled = F.transform("vector", lambda x: x.cast("double") / F.col("_n"))
    return vectors.withColumn("_n", norm).where("_n > 0").select(word_col, scaled.alias("unit"))


def _numbered(units: DataFrame, name: str) -> DataFrame:
    """(name, unit, k): ``k`` numbers the names, which are unique, in their order, so ties by ``k`` are ties by name."""
    return cut_lineage(position_index(units, name, "k"))


def _side(df: DataFrame) -> DataFrame:
    return df.select("k", F.col("unit").alias("x"))


def similar_words(vectors: DataFrame, queries: DataFrame, top_n: int = 10, word_col: str = "word") -> DataFrame:
    """For each word of a table of queries, the nearest other words by
    cosine similarity, then word; queries meet all words in blocks of bounded
    size.  Unknown query words give no row."""
    words = _numbered(unit_vectors(vectors, word_col), word_col)
    asked = words.join(queries.select(word_col).distinct(), word_col, "left_semi")
    found = exact_nearest(_side(words), _side(asked), top_n)
    return (found.join(asked.select(F.col("k").alias("a"), F.col(word_col).alias("query")), "a")
            .join(words.select(F.col("k").alias("b"), word_col), "b")
            .select("query", word_col, F.col("sim").alias("similarity"), "rank"))


def analogies(vectors: DataFrame, queries: DataFrame, top_n: int = 10, word_col: str = "word") -> DataFrame:
    """E5: for each query (query, word, sign +1 or -1), the words nearest to
    the mean of the signed unit vectors, without the query's own words.
    Unknown words are left out of the mean."""
    units = unit_vectors(vectors, word_col)
    signed = units.join(queries, word_col).select(
        "query", word_col, F.posexplode(F.transform("unit", lambda x: x * F.col("sign"))).alias("i", "x"))
    mean = signed.groupBy("query", "i").agg(F.avg("x").alias("x"))
    vector = mean.groupBy("query").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("vector"))
    words = _numbered(units, word_col)
    # Queries are numbered below 0, apart from the words.
    asked = _numbered(unit_vectors(vector, "query"), "query").withColumn("k", -1 - F.col("k"))
    own = queries.select("query", word_col).distinct()
    most = own.groupBy("query").count().agg(F.max("count")).first()[0] or 0
    found = exact_nearest(_side(words), _side(asked), top_n + most)
    named = (found.join(asked.select(F.col("k").alias("a"), "query"), "a").join(words.select(F.col("k").alias("b"), word_col), "b")
             .join(own, ["query", word_col], "left_anti"))
    w = Window.partitionBy("query").orderBy(F.desc(F.round("sim", 9)), F.asc(word_col))
    return (named.select("query", word_col, F.col("sim").alias("similarity"), F.row_number().over(w).cast("long").alias("rank"))
            .where(F.col("rank") <= top_n))


def save_model(model, path: str) -> None:
    """Persist a fitted model / pipeline."""
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
