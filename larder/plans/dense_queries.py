"""Dense vectors: exact and indexed neighbours (V6), the Euclidean silhouette (C7), a model round trip."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from larder.operators.cluster_metrics import points
from larder.operators.dense_index import build_index, exact_nearest, recall, search, unit_rows
from larder.operators.euclid import euclidean_silhouettes
from larder.operators.models import load_pipeline, save_model
from larder.plans.registry import register
from larder.session import cut_lineage, ensure_checkpoint_dir
from larder.sources.tables import read_table

_LONG = """e as (select vec_id, label, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as d from embeddings),
q as (select * from e where vec_id % 50 = 0)"""


@register("silhouette_euclidean", f"""with {_LONG},
dist as (select q.vec_id, any_value(q.label) as own, any_value(e.label) as label, e.vec_id as other, sqrt(sum((q.x - e.x) * (q.x - e.x))) as far
         from q join e using (d) group by q.vec_id, e.vec_id),
per as (select vec_id, own, label, sum(far) as total, count(*) as n from dist group by all),
ab as (select vec_id, own, max(case when label = own then n end) as n, max(case when label = own and n > 1 then total / (n - 1) end) as a,
              min(case when label <> own then total / n end) as b from per group by all)
select vec_id, cast(own as bigint) as label,
       round(case when n <= 1 or b is null or greatest(a, b) = 0 then 0.0 else (b - a) / greatest(a, b) end, 9) as silhouette from ab""")
def q_silhouette_euclidean(spark, sf_dir):
    """Ids divisible by 50 against all rows."""
    pts = points(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    s = euclidean_silhouettes(pts, pts.where("key % 50 = 0"))
    return s.select(F.col("key").alias("vec_id"), "label", F.round("silhouette", 9).alias("silhouette"))


def _units(spark, sf_dir):
    rows = cut_lineage(unit_rows(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding"))
    return rows, rows.where("k % 50 = 0")


def _named(found):
    return found.select(F.col("a").alias("vec_id"), F.col("b").alias("neighbour"), F.round("sim", 9).alias("similarity"), "rank")


@register("nearest_embeddings", f"""with {_LONG},
norms as (select vec_id, sqrt(sum(x * x)) as norm from e group by vec_id),
sims as (select q.vec_id, e.vec_id as neighbour, sum(q.x * e.x) as dot from q join e on e.d = q.d and e.vec_id <> q.vec_id group by all),
r as (select s.vec_id, neighbour, round(dot / (a.norm * b.norm), 9) as similarity
      from sims s join norms a using (vec_id) join norms b on b.vec_id = s.neighbour where a.norm > 0 and b.norm > 0)
select *, row_number() over (partition by vec_id order by similarity desc, neighbour) as rank from r
qualify rank <= 10""")
def q_nearest_embeddings(spark, sf_dir):
    """The ten nearest rows, exactly, of ids divisible by 50."""
    return _named(exact_nearest(*_units(spark, sf_dir)))


@register("similar_embeddings")
def q_similar_embeddings(spark, sf_dir):
    """The same through the inverted file."""
    rows, asked = _units(spark, sf_dir)
    return _named(search(build_index(rows), rows, asked))


@register("embedding_index_recall")
def q_embedding_index_recall(spark, sf_dir):
    """Recall of the inverted file at ten, against the exact answer."""
    rows, asked = _units(spark, sf_dir)
    return recall(search(build_index(rows), rows, asked), exact_nearest(rows, asked))


@register("model_round_trip", """with e as (select vec_id, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as d from embeddings),
s as (select d, avg(x) as m, stddev_samp(x) as sd from e group by d)
select vec_id, round(sum(power(case when sd > 0 then (x - m) / sd else 0 end, 2)), 6) as squares, true as same
from e join s using (d) group by vec_id""")
def q_model_round_trip(spark, sf_dir):
    """A fitted pipeline is saved to the shared folder, read back, and
    gives the same rows as the one that was fitted."""
    emb = read_table(spark, sf_dir, "embeddings")
    feats = emb.select("vec_id", array_to_vector(F.transform("embedding", lambda v: v.cast("double"))).alias("features"))
    fitted = Pipeline(stages=[StandardScaler(inputCol="features", outputCol="z", withMean=True)]).fit(feats)
    path = f"{ensure_checkpoint_dir(spark)}/model-{uuid.uuid4().hex}"
    save_model(fitted, path)
    z = lambda m, out: m.transform(feats).select("vec_id", vector_to_array("z").alias(out))
    both = z(load_pipeline(path), "z").join(z(fitted, "w"), "vec_id")
    squares = F.aggregate("z", F.lit(0.0), lambda acc, v: acc + v * v)
    return both.select("vec_id", F.round(squares, 6).alias("squares"), (F.col("z") == F.col("w")).alias("same"))
