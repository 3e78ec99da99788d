"""Cluster validation on fixed labels.

Everything is computed from per-cluster sufficient statistics (count, sum of
squared norms, feature-sum vector), so each metric is linear in the points:
one aggregate builds the k cluster summaries, which are attached to every
point as a small broadcast array (k summaries, checked), and the per-point
work is array arithmetic in the map stage.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.operators.aggregates import attach_one_row

MAX_CLUSTERS = 100_000


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def _norm2(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v * v)


def points(df: DataFrame, key: str, features: str, label: str) -> DataFrame:
    """(key, label, x array<double>, n2 = ||x||^2)."""
    x = F.transform(F.col(features), lambda v: v.cast("double"))
    return df.select(F.col(key).alias("key"), F.col(label).alias("label"), x.alias("x")).withColumn("n2", _norm2(F.col("x")))


def cluster_summaries(pts: DataFrame) -> DataFrame:
    """(label, n, psi = sum ||x||^2, s = feature sum).  The feature sum is a
    JVM-side vector aggregate (``Summarizer``), no explode."""
    agg = pts.groupBy("label").agg(
        F.count(F.lit(1)).cast("long").alias("n"), F.sum("n2").alias("psi"),
        Summarizer.sum(array_to_vector(F.col("x"))).alias("sv"))
    return agg.select("label", "n", "psi", vector_to_array("sv").alias("s"))


def _with_all_clusters(pts: DataFrame, summ: DataFrame) -> DataFrame:
    """Attach every cluster summary (one array, <= MAX_CLUSTERS entries) to
    every point: a one-row broadcast whose size is checked first."""
    from pyspark import StorageLevel
    summ = summ.persist(StorageLevel.MEMORY_AND_DISK)
    k = summ.count()
    if k > MAX_CLUSTERS:
        raise ValueError(f"{k} clusters: the per-point silhouette needs at most {MAX_CLUSTERS}")
    packed = summ.agg(F.collect_list(F.struct("label", "n", "psi", "s")).alias("clusters"),
                      F.count(F.lit(1)).alias("k"))
    return attach_one_row(pts, packed)


def inertia(pts: DataFrame) -> DataFrame:
    """Sum of squared distances to the own centroid,
    sum_c (psi_c - ||s_c||^2 / n_c)."""
    summ = cluster_summaries(pts)
    return summ.agg(F.sum(F.col("psi") - _norm2(F.col("s")) / F.col("n")).alias("inertia"))


def calinski_harabasz(pts: DataFrame) -> DataFrame:
    """(B / (k-1)) / (W / (n-k)) with B = sum_c n_c ||mu_c - mu||^2 and W
    the inertia; NULL when k < 2 or n = k."""
    summ = cluster_summaries(pts)
    tot = summ.agg(F.sum("n").alias("n_total"), F.count(F.lit(1)).alias("k"),
                   Summarizer.sum(array_to_vector(F.col("s"))).alias("tv"))
    tot = tot.select("n_total", "k", vector_to_array("tv").alias("t"))
    j = attach_one_row(summ, tot)
    mu_c = F.transform(F.col("s"), lambda v: v / F.col("n"))
    mu = F.transform(F.col("t"), lambda v: v / F.col("n_total"))
    diff = F.zip_with(mu_c, mu, lambda a, b: a - b)
    per = j.select("n_total", "k", (F.col("n") * _norm2(diff)).alias("b"),
                   (F.col("psi") - _norm2(F.col("s")) / F.col("n")).alias("w"))
    out = per.groupBy("n_total", "k").agg(F.sum("b").alias("between"), F.sum("w").alias("within"))
    nt, k = F.col("n_total"), F.col("k")
    return out.select(F.when((k > 1) & (nt > k) & (F.col("within") > 0),
                             (F.col("between") / (k - 1)) / (F.col("within") / (nt - k)))
                      .alias("calinski_harabasz"))


def silhouette_samples(pts: DataFrame) -> DataFrame:
    """Per-point silhouette with squared Euclidean distance.

    Mean squared distance of x to cluster c is ||x||^2 + psi_c/n_c -
    2 x.s_c/n_c; the own-cluster value is rescaled by n/(n-1) to exclude the
    point itself; a singleton cluster scores 0."""
    summ = cluster_summaries(pts)
    j = _with_all_clusters(pts, summ)
    dists = F.transform(F.col("clusters"), lambda c: F.struct(
        c["label"].alias("label"), c["n"].alias("n"),
        (F.col("n2") + c["psi"] / c["n"] - 2.0 * _dot(F.col("x"), c["s"]) / c["n"]).alias("d")))
    own = F.filter(dists, lambda c: c["label"] == F.col("label"))[0]
    others = F.filter(dists, lambda c: c["label"] != F.col("label"))
    b = F.array_min(F.transform(others, lambda c: c["d"]))
    a = own["d"] * own["n"] / (own["n"] - 1)
    s = (F.when(own["n"] <= 1, F.lit(0.0))
         .when(b.isNull(), F.lit(0.0))
         .when(a < b, 1.0 - a / b)
         .when(a > b, b / a - 1.0)
         .otherwise(F.lit(0.0)))
    return j.select("key", "label", s.alias("silhouette"))


def silhouette(pts: DataFrame) -> DataFrame:
    """Mean of the per-point silhouettes (squared Euclidean)."""
    return silhouette_samples(pts).agg(F.avg("silhouette").alias("silhouette"))


def adjusted_rand_index(df: DataFrame, a: str, b: str) -> DataFrame:
    """ARI from the contingency table (one groupBy) and its margins."""
    cont = df.groupBy(a, b).agg(F.count(F.lit(1)).cast("double").alias("nij"))
    c2 = lambda x: x * (x - 1) / 2.0
    idx = cont.agg(F.sum(c2(F.col("nij"))).alias("index"), F.sum("nij").alias("n"))
    ra = cont.groupBy(a).agg(F.sum("nij").alias("ai")).agg(F.sum(c2(F.col("ai"))).alias("sa"))
    rb = cont.groupBy(b).agg(F.sum("nij").alias("bj")).agg(F.sum(c2(F.col("bj"))).alias("sb"))
    j = attach_one_row(attach_one_row(idx, ra), rb)
    expected = F.col("sa") * F.col("sb") / c2(F.col("n"))
    mx = (F.col("sa") + F.col("sb")) / 2.0
    return j.select(F.when(mx == expected, F.lit(1.0))
                    .otherwise((F.col("index") - expected) / (mx - expected)).alias("ari"))


def noise_stats(labels: DataFrame, label: str = "label") -> DataFrame:
    """C14: noise count (label -1) and ratio."""
    return labels.agg(F.sum(F.when(F.col(label) == -1, 1).otherwise(0)).cast("long").alias("n_noise"),
                      F.avg(F.when(F.col(label) == -1, 1.0).otherwise(0.0)).alias("noise_ratio"))


def standardize(df: DataFrame, cols: list[str]) -> DataFrame:
    """V3: mean-impute then (x - mean) / population std for the columns
    present; one aggregate for the statistics, attached as one row."""
    cols = [c for c in cols if c in df.columns]
    stats = df.agg(*[F.avg(c).alias(f"{c}__m") for c in cols], *[F.stddev_pop(c).alias(f"{c}__s") for c in cols])
    j = attach_one_row(df, stats)
    out = j
    for c in cols:
        filled = F.coalesce(F.col(c).cast("double"), F.col(f"{c}__m"))
        out = out.withColumn(c, F.when(F.col(f"{c}__s") > 0, (filled - F.col(f"{c}__m")) / F.col(f"{c}__s"))
                             .otherwise(F.lit(0.0)))
    return out.drop(*[f"{c}__m" for c in cols], *[f"{c}__s" for c in cols])
