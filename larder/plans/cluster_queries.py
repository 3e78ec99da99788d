"""Cluster-validation queries on fixed labels."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from larder.operators import cluster_metrics as C
from larder.operators.tfidf import centroid_top_terms, tfidf
from larder.plans.registry import register
from larder.plans.sqlkit import with_catalogue
from larder.plans.text_queries import _tfidf_sql
from larder.sources.tables import catalogue, read_table

_EMB = """e as (select vec_id, label, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as d from embeddings),
n2 as (select vec_id, label, sum(x * x) as n2 from e group by all),
cs as (select label, d, sum(x) as s from e group by all),
cl as (select n2.label, count(*) as n, sum(n2.n2) as psi, any_value(q.ss) as ss
       from n2 join (select label, sum(s * s) as ss from cs group by label) q using (label) group by n2.label)"""

_SIL = _EMB + """,
dots as (select e.vec_id, cs.label as c, sum(e.x * cs.s) as dot from e join cs on cs.d = e.d group by all),
dist as (select n2.vec_id, n2.label, dots.c, cl.n, n2.n2 + cl.psi / cl.n - 2 * dots.dot / cl.n as dd
         from n2 join dots using (vec_id) join cl on cl.label = dots.c),
ab as (select vec_id, label, max(case when c = label then dd * n / (n - 1) end) as a,
              max(case when c = label then n end) as own_n, min(case when c <> label then dd end) as b
       from dist group by all),
s as (select vec_id as key, label, case when own_n <= 1 then 0.0 when b is null then 0.0 when a < b then 1 - a / b
                                        when a > b then b / a - 1 else 0.0 end as silhouette from ab)"""


def _pts(spark, sf_dir):
    emb = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return C.points(emb, "vec_id", "embedding", "label")


@register("silhouette_labels", f"with {_SIL}\nselect round(avg(silhouette), 9) as silhouette from s")
def q_silhouette_labels(spark, sf_dir):
    return C.silhouette(_pts(spark, sf_dir)).select(F.round("silhouette", 9).alias("silhouette"))


@register("silhouette_samples", f"""with {_SIL}
select key as vec_id, label, round(silhouette, 9) as silhouette,
       row_number() over (partition by label order by round(silhouette, 9), key) as rank_in_cluster from s""")
def q_silhouette_samples(spark, sf_dir):
    s = C.silhouette_samples(_pts(spark, sf_dir)).withColumn("silhouette", F.round("silhouette", 9))
    w = Window.partitionBy("label").orderBy("silhouette", "key")
    return s.select(F.col("key").alias("vec_id"), "label", "silhouette",
                    F.row_number().over(w).cast("long").alias("rank_in_cluster"))


@register("inertia_labels", f"with {_EMB}\nselect round(sum(psi - ss / n), 6) as inertia from cl")
def q_inertia_labels(spark, sf_dir):
    return C.inertia(_pts(spark, sf_dir)).select(F.round("inertia", 6).alias("inertia"))


@register("calinski_harabasz_labels", f"""with {_EMB},
tot as (select d, sum(s) as t from cs group by d),
nn as (select sum(n) as nn, count(*) as k from cl),
b as (select cs.label, sum(power(cs.s / cl.n - tot.t / nn.nn, 2)) * any_value(cl.n) as b
      from cs join cl using (label) join tot using (d), nn group by cs.label),
w as (select sum(psi - ss / n) as w from cl)
select round((sum(b.b) / (any_value(nn.k) - 1)) / (any_value(w.w) / (any_value(nn.nn) - any_value(nn.k))), 6)
       as calinski_harabasz from b, w, nn""")
def q_calinski_harabasz_labels(spark, sf_dir):
    return C.calinski_harabasz(_pts(spark, sf_dir)).select(
        F.round("calinski_harabasz", 6).alias("calinski_harabasz"))


@register("ari_quality_toxic", """
with cont as (select quality, toxic, count(*)::double as nij from labels group by all),
t as (select sum(nij * (nij - 1) / 2) as idx, sum(nij) as n from cont),
a as (select sum(ai * (ai - 1) / 2) as sa from (select quality, sum(nij) as ai from cont group by 1)),
b as (select sum(bj * (bj - 1) / 2) as sb from (select toxic, sum(nij) as bj from cont group by 1))
select round(case when (sa + sb) / 2 = sa * sb / (n * (n - 1) / 2) then 1.0
            else (idx - sa * sb / (n * (n - 1) / 2)) / ((sa + sb) / 2 - sa * sb / (n * (n - 1) / 2)) end, 9) as ari
from t, a, b""")
def q_ari_quality_toxic(spark, sf_dir):
    lab = read_table(spark, sf_dir, "labels").select("quality", "toxic")
    return C.adjusted_rand_index(lab, "quality", "toxic").select(F.round("ari", 9).alias("ari"))


@register("standardized_nutrients", with_catalogue("""
, st as (select avg(sugar_100g) as ms, stddev_pop(sugar_100g) as ss, avg(salt_100g) as ml, stddev_pop(salt_100g) as sl,
                avg(fat_100g) as mf, stddev_pop(fat_100g) as sf from catalogue)
select code, round((coalesce(sugar_100g, ms) - ms) / ss, 9) as sugar_100g, round((salt_100g - ml) / sl, 9) as salt_100g,
       round((fat_100g - mf) / sf, 9) as fat_100g from catalogue, st"""))
def q_standardized_nutrients(spark, sf_dir):
    cols = ["sugar_100g", "salt_100g", "fat_100g", "energy_kcal", "proteins"]
    z = C.standardize(catalogue(spark, sf_dir).select("code", "sugar_100g", "salt_100g", "fat_100g"), cols)
    return z.select("code", *[F.round(c, 9).alias(c) for c in ("sugar_100g", "salt_100g", "fat_100g")])


@register("cluster_top_terms", "with " + _tfidf_sql("documents", "doc_id", "text", 0.5, 1, 1000)[1:] + """,
sizes as (select quality, count(*) as size from labels group by quality),
mean as (select l.quality, w.term, sum(w.weight) / any_value(sz.size) as weight
         from w join labels l on l.doc_id = w.key join sizes sz on sz.quality = l.quality group by all),
r as (select *, row_number() over (partition by quality order by round(weight, 12) desc, term) as rank from mean)
select quality, term, round(weight, 9) as weight, rank from r where rank <= 10""")
def q_cluster_top_terms(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    w, _ = tfidf(docs, "doc_id", "text", max_df=0.5, max_features=1000)
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    out = centroid_top_terms(w, lab, "doc_id", "quality", 10)
    return out.select("quality", "term", F.round("weight", 9).alias("weight"), F.col("rank").cast("long"))
