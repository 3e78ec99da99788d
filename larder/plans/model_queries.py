"""Fitted-model queries (rows-only checks: randomised / iterative results)."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import fixed
from larder.operators import models as M
from larder.operators.aggregates import crosstab
from larder.operators.clean import dashboard_catalogue, valid_nova
from larder.operators.pairs import ingredient_sequences
from larder.operators.positions import position_index
from larder.operators.scoring import score_catalogue
from larder.operators.category_pairs import category_pairs
from larder.operators.kmeans_sweep import kmeans_sweep
from larder.operators.mixtures import KINDS, kmeans_starts, mixture_sweep, sweep_table
from larder.plans.registry import register, rounded
from larder.plans.sqlkit import with_catalogue, with_dash
from larder.plans.text_queries import _tfidf_sql
from larder.session import cut_lineage
from larder.sources.tables import catalogue, read_table


def _clustering(spark, sf_dir):
    dash = dashboard_catalogue(catalogue(spark, sf_dir))
    return M.run_clustering(spark, dash.select("code", "ingredients_text"), "code", "ingredients_text", k=5)


@register("kmeans_clusters")
def q_kmeans_clusters(spark, sf_dir):
    """C1 + V5: cluster label and 2-D PCA coordinates per product."""
    return _clustering(spark, sf_dir)["labels"]


@register("kmeans_top_terms")
def q_kmeans_top_terms(spark, sf_dir):
    """Ten strongest centroid terms per cluster."""
    return _clustering(spark, sf_dir)["terms"]


def _labelled(spark, sf_dir):
    res = _clustering(spark, sf_dir)
    scored = score_catalogue(dashboard_catalogue(catalogue(spark, sf_dir)))
    return scored.join(res["labels"], "code")


@register("cluster_processing_stats")
def q_cluster_processing_stats(spark, sf_dir):
    """Mean score, share above 60 and named-product count per cluster."""
    return _processing_stats(_labelled(spark, sf_dir))


def _processing_stats(labelled):
    return labelled.groupBy("cluster").agg(
        F.avg("processing_score").alias("avg_score"),
        (F.avg(F.when(F.col("processing_score") > fixed.ULTRA_PROCESSED_THRESHOLD, 1.0).otherwise(0.0)) * 100)
        .alias("upf_pct"),
        F.count("product_name").alias("count"))


@register("cluster_sizes")
def q_cluster_sizes(spark, sf_dir):
    """A17."""
    return _labelled(spark, sf_dir).groupBy("cluster").count()


@register("cluster_nova_crosstab")
def q_cluster_nova_crosstab(spark, sf_dir):
    """Clusters against valid NOVA groups."""
    return crosstab(valid_nova(_labelled(spark, sf_dir)), "cluster", "nova_group", ["1", "2", "3", "4"], "nova_")


def _bigram_features(spark, sf_dir):
    c = catalogue(spark, sf_dir)
    t = F.lower(F.coalesce(F.nullif(F.col("ingredients_text"), F.lit("")), F.lit("unknown")))
    feats, _ = M.tfidf_vectors(c.select("code", t.alias("text")), "code", "text", max_df=0.8, min_df=2,
                               max_features=100, ngram_range=(1, 2))
    return cut_lineage(feats)


# The same three aggregates over a fixed labelling, which SQL can state.
def _fixed_labels(spark, sf_dir):
    scored = score_catalogue(dashboard_catalogue(catalogue(spark, sf_dir)))
    return scored.withColumn("cluster", (F.col("code") % 5).cast("int"))


@register("label_processing_stats", with_dash("""
select cast(code % 5 as integer) as cluster, round(avg(processing_score), 9) as avg_score,
       round(avg(case when processing_score > 60 then 1.0 else 0.0 end) * 100, 9) as upf_pct, count(product_name) as count
from scored group by 1""", scored=True))
def q_label_processing_stats(spark, sf_dir):
    """A7 and A17 on a fixed labelling."""
    return rounded(_processing_stats(_fixed_labels(spark, sf_dir)), ["avg_score", "upf_pct"])


@register("label_nova_crosstab", with_dash("""
select cast(code % 5 as integer) as cluster, """ + ", ".join(
    f"cast(sum(case when nova_group = '{n}' then 1 else 0 end) as bigint) as nova_{n}" for n in "1234") + """
from scored where nova_group is not null and nova_group <> 'unknown' group by 1""", scored=True))
def q_label_nova_crosstab(spark, sf_dir):
    """C16 on a fixed labelling."""
    return crosstab(valid_nova(_fixed_labels(spark, sf_dir)), "cluster", "nova_group", ["1", "2", "3", "4"], "nova_")


@register("kmeans_elbow")
def q_kmeans_elbow(spark, sf_dir):
    """Inertia of the best of ten starts for k = 2..11."""
    return kmeans_sweep(spark, _bigram_features(spark, sf_dir), "code", range(2, 12)).select("k", "inertia")


@register("kmeans_analysis")
def q_kmeans_analysis(spark, sf_dir):
    """K from 2 to 15, five runs of ten starts each; silhouette,
    Calinski-Harabasz and inertia of the best run, and the stability."""
    return M.kmeans_analysis(spark, _bigram_features(spark, sf_dir), "code")


@register("bootstrap_stability")
def q_bootstrap_stability(spark, sf_dir):
    """C11: ARI of 10 refits on 80 % hash subsamples against the base fit."""
    return M.bootstrap_stability(spark, _bigram_features(spark, sf_dir), "code", k=5)


def _emb_features(spark, sf_dir):
    emb = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    x = F.transform("embedding", lambda v: v.cast("double"))
    return cut_lineage(emb.select("vec_id", "label", array_to_vector(x).alias("features")))


@register("gmm_selection")
def q_gmm_selection(spark, sf_dir):
    """Diagonal, spherical, tied and full mixtures with 2 to 15
    components; silhouette, BIC and AIC."""
    feats = _emb_features(spark, sf_dir)
    starts = kmeans_starts(feats, range(2, 16))
    tables = [sweep_table(spark, feats, kind, mixture_sweep(feats, range(2, 16), kind, starts=starts)) for kind in KINDS]
    return reduce(DataFrame.unionByName, tables)


@register("gmm_probabilities")
def q_gmm_probabilities(spark, sf_dir):
    """Component probabilities per point (each row sums to 1).  Two
    full-covariance components: with 64 dimensions, more components leave
    too few points per covariance matrix at the small scale factors."""
    feats = _emb_features(spark, sf_dir)
    m = M.GaussianMixture(k=2, seed=42, featuresCol="features").fit(feats)
    return m.transform(feats).select("vec_id", "prediction", vector_to_array("probability").alias("probability"))


@register("pca_embeddings")
def q_pca_embeddings(spark, sf_dir):
    """V5 on the dense embeddings."""
    coords, _ = M.pca_2d(_emb_features(spark, sf_dir), "vec_id")
    return coords


def _w2v(spark, sf_dir):
    seqs = ingredient_sequences(catalogue(spark, sf_dir))
    return M.train_embeddings(seqs, max_iter=100)


@register("ingredient_vectors")
def q_ingredient_vectors(spark, sf_dir):
    """Learnt ingredient vectors."""
    return _w2v(spark, sf_dir).getVectors().select("word", vector_to_array("vector").alias("vector"))


# E3-E5 on the embeddings table, whose rows stand for words.
_UNIT = """u as (select vec_id as word, list_transform(embedding, lambda x: cast(x as double) /
  sqrt(list_sum(list_transform(embedding, lambda y: cast(y as double) * cast(y as double))))) as unit
  from embeddings where list_sum(list_transform(embedding, lambda y: cast(y as double) * cast(y as double))) > 0)"""


def _vectors(spark, sf_dir):
    return read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("word"), F.transform("embedding", lambda x: x.cast("double")).alias("vector"))


@register("embedding_lookup", """
select q.word, round(list_sum(coalesce(list_transform(e.embedding, lambda x: cast(x as double)), [0.0])), 6) as total,
       e.vec_id is null as unknown
from (select vec_id * 2 as word from embeddings) q left join embeddings e on e.vec_id = q.word""")
def q_embedding_lookup(spark, sf_dir):
    """Known words get their vector, unknown ones a zero vector."""
    v = _vectors(spark, sf_dir)
    size = F.size("vector")
    width = v.select(size.alias("n")).first()["n"]
    got = M.embedding_of(v, v.select((F.col("word") * 2).alias("word")), width)
    total = F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x)
    zero = ~F.exists("vector", lambda x: x != 0)
    return got.select("word", F.round(total, 6).alias("total"), (zero & (size == width)).alias("unknown"))


@register("similar_words", f"""
with {_UNIT},
q as (select word, unit from u where word % 50 = 0),
s as (select q.word as query, u.word, list_sum(list_transform(list_zip(q.unit, u.unit), lambda p: p[1] * p[2])) as similarity
      from q join u on u.word <> q.word),
r as (select *, row_number() over (partition by query order by round(similarity, 9) desc, word) as rank from s)
select query, word, round(similarity, 6) as similarity, rank from r where rank <= 10""")
def q_similar_words(spark, sf_dir):
    """The ten nearest of all words for each id divisible by 50."""
    v = _vectors(spark, sf_dir)
    return rounded(M.similar_words(v, v.where("word % 50 = 0"), 10), ["similarity"], 6)


@register("word_analogies", f"""
with {_UNIT},
q as (select vec_id as query, vec_id + unnest([0, 1, 2]) as word, unnest([1, 1, -1]) as sign from embeddings where vec_id % 50 = 0),
m as (select query, i, avg(q.sign * u.unit[i]) as x from q join u using (word), unnest(range(1, 65)) t(i) group by all),
t as (select query, list(x order by i) as v, sqrt(sum(x * x)) as n from m group by query),
s as (select t.query, u.word, list_sum(list_transform(list_zip(t.v, u.unit), lambda p: p[1] * p[2])) / t.n as similarity
      from t join u on not exists (select 1 from q where q.query = t.query and q.word = u.word)),
r as (select *, row_number() over (partition by query order by round(similarity, 9) desc, word) as rank from s)
select query, word, round(similarity, 6) as similarity, rank from r where rank <= 10""")
def q_word_analogies(spark, sf_dir):
    """E5: a word with an id divisible by 50 and the next less the one after, against all words."""
    v = _vectors(spark, sf_dir)
    part = F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.lit(sign).alias("sign")) for n, sign in ((0, 1), (1, 1), (2, -1))]))
    queries = v.where("word % 50 = 0").select(F.col("word").alias("query"), part.alias("p")).select(
        "query", (F.col("query") + F.col("p.n")).alias("word"), "p.sign")
    return rounded(M.analogies(v, queries, 10), ["similarity"], 6)


@register("similar_ingredients")
def q_similar_ingredients(spark, sf_dir):
    """E4 on learnt vectors: nearest ingredients of every fiftieth word in their order."""
    model = _w2v(spark, sf_dir)
    vectors = model.getVectors().select("word", vector_to_array("vector").alias("vector"))
    return M.similar_words(vectors, position_index(vectors.select("word"), "word").where("pos % 50 = 0"), 10)


@register("bisecting_analysis")
def q_bisecting_analysis(spark, sf_dir):
    """Divisive hierarchical clustering, 2 to 15 clusters (see README on C5)."""
    return M.bisecting_analysis(spark, _bigram_features(spark, sf_dir))


@register("bisecting_labels")
def q_bisecting_labels(spark, sf_dir):
    return M.bisecting_labels(_bigram_features(spark, sf_dir), "code", 5)


@register("combined_features")
def q_combined_features(spark, sf_dir):
    """V4: every non-zero value of the bigram TF-IDF vector plus standardised
    nutrients, one row each (the nutrients stand behind the terms)."""
    from larder.operators.cluster_metrics import standardize
    feats = _bigram_features(spark, sf_dir)
    nut = standardize(catalogue(spark, sf_dir).select("code", "sugar_100g", "salt_100g", "fat_100g"),
                      ["sugar_100g", "salt_100g", "fat_100g"])
    comb = M.combined_features(feats.join(nut, "code"), "features", ["sugar_100g", "salt_100g", "fat_100g"])
    values = comb.select("code", F.posexplode(vector_to_array("combined")).alias("feature", "value"))
    return values.where("value <> 0").select("code", "feature", F.round("value", 6).alias("value"))


@register("clustering_report")
def q_clustering_report(spark, sf_dir):
    """C15 + T5: the best setting of every algorithm by its own score, and the
    bootstrap stability — one table of findings.  Scores are silhouettes, but
    for DBSCAN, where the most clusters among valid settings are taken."""
    from larder.operators import dbscan as D
    feats = _bigram_features(spark, sf_dir)
    emb = _emb_features(spark, sf_dir)
    from larder.plans.dbscan_queries import GRID_EPS, GRID_MIN_SAMPLES, _inputs

    def best(results, finding, setting, score):
        pick = results.where(F.col(score).isNotNull()).agg(F.max_by(setting, F.struct(F.col(score), setting)).alias("setting"),
                                                            F.max(score).alias("score"))
        return pick.select(F.lit(finding).alias("finding"), "setting", F.col("score").cast("double").alias("score"))

    label = lambda *parts: F.concat_ws(" ", *[F.concat(F.lit(f"{n}="), F.col(n).cast("string")) for n in parts])
    grid = D.dbscan_grid(*_inputs(spark, sf_dir), "doc_id", GRID_EPS, GRID_MIN_SAMPLES).where("valid")
    boot = M.bootstrap_stability(spark, feats, "code", k=5).agg(F.avg("ari").alias("m"), F.stddev_pop("ari").alias("s"))
    return (best(M.kmeans_analysis(spark, feats, "code"), "kmeans", label("k"), "silhouette")
            .unionByName(best(M.bisecting_analysis(spark, feats), "bisecting", label("k"), "silhouette"))
            .unionByName(best(M.gmm_selection(spark, emb, (2, 15), ("diag",)), "mixture", label("covariance", "n_components"), "silhouette"))
            .unionByName(best(grid, "dbscan", label("eps", "min_samples"), "n_clusters"))
            .unionByName(boot.select(F.lit("kmeans stability").alias("finding"), F.concat(F.lit("std="), F.round("s", 4).cast("string"))
                                     .alias("setting"), F.col("m").alias("score"))))


@register("cluster_interpretation", with_catalogue(""", cat_docs as (select code, lower(coalesce(nullif(ingredients_text, ''), 'unknown')) as text from catalogue),"""
    + _tfidf_sql("cat_docs", "code", "text", 0.8, 2, 100, bigrams=True) + """,
lab as (select code, cast(code % 5 as integer) as cluster, product_name from catalogue),
size as (select cluster, count(*) as n_products from lab group by cluster),
mean as (select l.cluster, w.term, sum(w.weight) as s from w join lab l on l.code = w.key group by all),
top as (select m.cluster, m.term, row_number() over (partition by m.cluster order by round(m.s / z.n_products, 12) desc, m.term) as r
        from mean m join size z using (cluster)),
words as (select cluster, string_agg(term, ', ' order by r) as top_terms from top where r <= 5 group by cluster),
ex as (select cluster, code, product_name, row_number() over (partition by cluster order by md5(concat('42|', cast(code as varchar)))) as r from lab),
names as (select cluster, string_agg(coalesce(product_name, '?'), '; ' order by r) as samples from ex where r <= 5 group by cluster)
select cluster, n_products, top_terms, samples from size join words using (cluster) join names using (cluster)"""))
def q_cluster_interpretation(spark, sf_dir):
    """C13 + W4 + F19: size, joined five strongest terms and five sample
    products (seeded) of each cluster of a fixed labelling."""
    from larder.operators.tfidf import interpret_clusters, tfidf
    cat = catalogue(spark, sf_dir)
    t = F.lower(F.coalesce(F.nullif(F.col("ingredients_text"), F.lit("")), F.lit("unknown")))
    w, _ = tfidf(cat.select("code", t.alias("text")), "code", "text", max_df=0.8, min_df=2, max_features=100, ngram_range=(1, 2))
    labels = cat.select("code", (F.col("code") % 5).cast("int").alias("cluster"), "product_name")
    return interpret_clusters(w, labels, "code", "cluster", "product_name")


def _pairs(spark, sf_dir):
    from larder.operators.pairs import sample_pairs
    cat = catalogue(spark, sf_dir)
    n = cat.count()  # one positive pair per product on average, so the sample grows with the table
    return sample_pairs(spark, cat, n_positive=n, negative_ratio=1.0)


def _draw_sql(i: str, salt: str) -> str:
    return f"cast(concat('0x', substr(md5(concat('42|{salt}|', cast({i} as varchar))), 1, 15)) as bigint)"


_PAIRS_SQL = f""",
pos as (select code, category_searched, row_number() over (order by category_searched, code) - 1 as pos
        from catalogue where category_searched is not null),
cat0 as (select category_searched, min(pos) as off, count(*) as n_c from pos group by 1),
cat1 as (select *, row_number() over (order by category_searched) - 1 as cat_idx, n_c * (n_c - 1) / 2 as w from cat0),
cats as (select *, sum(w) over (order by cat_idx) as cum_hi from cat1),
tot as (select sum(w) as big, count(*) as c, (select count(*) from catalogue) as n from cats),
i as (select unnest(range(0, n)) as i, big, c, n from tot),
ps as (select i, n, {_draw_sql("i", "cat")} / 1152921504606846976.0 * big as u from i),
pc as (select ps.*, (select count(*) from cats where cum_hi <= ps.u) as cat_idx from ps),
pp as (select i as pair_id, off, n_c, {_draw_sql("i", "a")} % n_c as a, {_draw_sql("i", "b")} % (n_c - 1) as b0
       from pc join cats using (cat_idx) where n_c > 1),
pos_pairs as (select pair_id, off + a as p1, off + case when b0 >= a then b0 + 1 else b0 end as p2, 1 as label from pp),
ns as (select i, n, {_draw_sql("i", "c1")} % c as c1, {_draw_sql("i", "c2")} % (c - 1) as d from i where c > 1),
nc as (select i, n, c1, case when d >= c1 then d + 1 else d end as c2 from ns),
neg_pairs as (select nc.i + nc.n as pair_id, x.off + {_draw_sql("nc.i", "m1")} % x.n_c as p1,
                     y.off + {_draw_sql("nc.i", "m2")} % y.n_c as p2, 0 as label
              from nc join cats x on x.cat_idx = nc.c1 join cats y on y.cat_idx = nc.c2),
drawn as (select *, row_number() over (partition by least(p1, p2), greatest(p1, p2), label order by pair_id) as again
          from (select * from pos_pairs union all select * from neg_pairs)),
named as (select d.pair_id, x.code as product1, y.code as product2, x.category_searched as category1, y.category_searched as category2,
                 d.label from drawn d join pos x on x.pos = d.p1 join pos y on y.pos = d.p2 where again = 1)
"""


@register("training_pairs", with_catalogue(_PAIRS_SQL + "select * from named"))
def q_training_pairs(spark, sf_dir):
    """E6 (re-aimed): seeded sample of same-category (label 1) and
    cross-category (label 0) product pairs."""
    return _pairs(spark, sf_dir)


def _permuted_sql() -> str:
    """The rounds of the permutation, one CTE each."""
    keyed = lambda step, part: f"cast(concat('0x', substr(md5(concat('42|{step}|', cat_idx, '|', {part})), 1, 15)) as bigint)"
    last, ctes = "f0", []
    for i in range(3):
        ctes.append(f"fl{i} as (select * replace ((l + {keyed(2 * i, 'r')}) % ca as l) from {last})")
        ctes.append(f"fr{i} as (select * replace ((r + {keyed(2 * i + 1, 'l')}) % cb as r) from fl{i})")
        last = f"fr{i}"
    return ",\n".join(ctes) + f",\nplaced as (select off, pair, l * cb + r as u from {last})"


@register("category_pairs", with_catalogue(f""",
pos as (select code, category_searched, row_number() over (order by category_searched, code) - 1 as pos
        from catalogue where category_searched is not null),
cat0 as (select category_searched, min(pos) as off, count(*) as n_c from pos group by 1),
cats as (select off, row_number() over (order by category_searched) - 1 as cat_idx, least(n_c * (n_c - 1) // 2, 10 * n_c) as m,
                case when n_c % 2 = 0 then n_c // 2 else n_c end as ca, case when n_c % 2 = 0 then n_c - 1 else (n_c - 1) // 2 end as cb from cat0),
num as (select *, unnest(range(0, m)) as pair from cats where m > 0),
f0 as (select *, pair // cb as l, pair % cb as r from num),
{_permuted_sql()},
tri as (select off, pair, u, cast(floor((1 + sqrt(1 + 8.0::double * u)) / 2) as bigint) as i0 from placed),
tri2 as (select off, pair, u, case when i0 * (i0 - 1) // 2 > u then i0 - 1 when i0 * (i0 + 1) // 2 <= u then i0 + 1 else i0 end as i from tri)
select x.category_searched as category, pair, x.code as product1, y.code as product2
from tri2 join pos x on x.pos = off + u - i * (i - 1) // 2 join pos y on y.pos = off + i"""))
def q_category_pairs(spark, sf_dir):
    """Ten distinct in-category pairs for every product."""
    return category_pairs(catalogue(spark, sf_dir))


@register("pair_split", with_catalogue(_PAIRS_SQL + f"""
select label, {_draw_sql("pair_id", "fold")} % 10 < 8 as is_train, count(*) as n from named group by all"""))
def q_pair_split(spark, sf_dir):
    """The sizes of the 80/20 split."""
    from larder.operators.pairs import split_pairs
    return split_pairs(_pairs(spark, sf_dir)).groupBy("label", "is_train").agg(F.count(F.lit(1)).alias("n"))


@register("pair_model_eval")
def q_pair_model_eval(spark, sf_dir):
    """Pair classifier on hashed product/category features, 80/20 hash
    split, validation accuracy and log-loss; with and without the crossed
    category feature, which gives the label away."""
    from larder.operators.pairs import train_pair_model
    pairs = cut_lineage(_pairs(spark, sf_dir))
    rows = [train_pair_model(pairs, crossed=crossed)[1].withColumn("crossed", F.lit(crossed)) for crossed in (False, True)]
    return rows[0].unionByName(rows[1])
