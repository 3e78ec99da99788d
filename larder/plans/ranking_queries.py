"""Ranking-evaluation queries (M1-M9) with the catalogue recommender."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.operators import ranking as R
from larder.operators.alternatives import healthier_alternatives
from larder.operators.scoring import score_catalogue
from larder.plans.registry import register, rounded
from larder.plans.sqlkit import with_catalogue
from larder.sources.tables import catalogue

_EVAL_SQL = """,
topc as (select category_searched, count(*) as n from catalogue where category_searched is not null
         group by 1 order by n desc, category_searched limit 10),
topr as (select *, row_number() over (order by n desc, category_searched) as cat_rank,
                floor(100 / count(*) over ()) as per_cat from topc),
smp as (select c.code, c.product_name, c.category_searched, c.nova_group, t.cat_rank, t.per_cat,
               row_number() over (partition by c.category_searched
                                  order by md5(concat('42', '|', cast(c.code as varchar)))) as r
        from catalogue c join topr t using (category_searched)),
smp2 as (select *, row_number() over (order by cat_rank, r) as scenario_id from smp where r <= per_cat),
fn as (select product_name, min(code) as fcode from catalogue where product_name is not null group by 1),
sc as (select s.scenario_id, coalesce(f.fcode, s.code) as code, s.product_name as test_product,
              case when f.fcode is not null then fc.category_searched else s.category_searched end as test_category,
              case when f.fcode is not null then fc.nova_group else s.nova_group end as test_nova
       from smp2 s left join fn f on f.product_name = s.product_name left join catalogue fc on fc.code = f.fcode
       where s.scenario_id <= 100),
same0 as (select sc.scenario_id, c.product_name as item,
                 row_number() over (partition by sc.scenario_id order by c.code) as r
          from sc join catalogue c on c.category_searched = sc.test_category
          where c.product_name is not null
            and not (sc.test_product is not null and c.product_name = sc.test_product)),
catnames as (select distinct category_searched, product_name from catalogue where product_name is not null),
sim0 as (select sc.scenario_id, c.product_name as item,
                row_number() over (partition by sc.scenario_id order by c.code) as r
         from sc join catalogue c on c.nova_group = sc.test_nova
         where c.product_name is not null
           and not (sc.test_product is not null and c.product_name = sc.test_product)
           and not exists (select 1 from catnames cn
                           where cn.category_searched = sc.test_category and cn.product_name = c.product_name)),
rel as (select distinct scenario_id, item, 3 as rel from same0 where r <= 10
        union all select distinct scenario_id, item, 2 as rel from sim0 where r <= 15),
cand as (select sc.scenario_id, c.code as alt_code, c.product_name as item, c.processing_score as alt_score,
                c.processing_score < p.processing_score as strict
         from sc join scored p on p.code = sc.code
         join scored c on c.category_searched = p.category_searched and c.processing_score <= p.processing_score
         where not (p.product_name is not null and c.product_name is not null and c.product_name = p.product_name)),
flag as (select *, max(case when strict then 1 else 0 end) over (partition by scenario_id) as has_strict from cand),
recs0 as (select scenario_id, item, row_number() over (partition by scenario_id order by alt_score, alt_code) as rank
          from flag where strict or has_strict = 0),
recs as (select * from recs0 where rank <= 20)"""

_METRICS_SQL = """,
ks as (select scenario_id, unnest([5, 10, 20]) as k from sc),
itemcat as (select product_name as item, arg_min(category_searched, code) as category
            from catalogue where product_name is not null group by 1),
topk as (select ks.scenario_id, ks.k, r.rank, r.item, rl.rel, ic.category
         from ks join recs r on r.scenario_id = ks.scenario_id and r.rank <= ks.k
         left join rel rl on rl.scenario_id = r.scenario_id and rl.item = r.item
         left join itemcat ic on ic.item = r.item),
per as (select scenario_id, k, count(*) as n_recs, sum(case when rel is not null then 1 else 0 end) as hits,
               count(distinct case when rel is not null then item end) as dhits,
               sum(coalesce(rel, 0) / log2(rank + 1)) as dcg, count(distinct category) as n_cats
        from topk group by all),
nrel as (select scenario_id, count(*) as n_rel from rel group by 1),
ideal as (select ks.scenario_id, ks.k, rl.rel,
                 row_number() over (partition by ks.scenario_id, ks.k order by rl.rel desc, rl.item) as ir
          from ks join rel rl using (scenario_id)),
idcg as (select scenario_id, k, sum(rel / log2(ir + 1)) as idcg from ideal where ir <= k group by all),
m as (select ks.scenario_id, ks.k,
        case when coalesce(n_recs, 0) > 0 then cast(hits as double) / ks.k else 0.0 end as precision,
        case when coalesce(n_recs, 0) > 0 and coalesce(n_rel, 0) > 0 then cast(dhits as double) / n_rel else 0.0 end
          as recall,
        case when coalesce(n_recs, 0) > 0 and coalesce(n_rel, 0) > 0 and coalesce(idcg, 0) > 0 then dcg / idcg
             else 0.0 end as ndcg,
        case when coalesce(n_recs, 0) < 2 then 1.0 else cast(n_cats as double) / n_recs end as diversity
      from ks left join per using (scenario_id, k) left join nrel using (scenario_id)
      left join idcg using (scenario_id, k))"""


def _sql(body: str) -> str:
    return with_catalogue(_EVAL_SQL + _METRICS_SQL + "\n" + body, scored=True)


def _evaluation(spark, sf_dir):
    products = catalogue(spark, sf_dir)
    scored = score_catalogue(products)

    def recommender(scenarios):
        alts = healthier_alternatives(scored, top_n=20, targets=scenarios)
        return (scenarios.select("scenario_id", "code").join(alts, "code")
                .select("scenario_id", "rank", F.col("alt_name").alias("item")))

    return R.evaluate(products, recommender)


@register("ranking_scenarios", _sql("select scenario_id, code, test_product, test_category, test_nova from sc"))
def q_ranking_scenarios(spark, sf_dir):
    return _evaluation(spark, sf_dir)["scenarios"]


@register("ranking_relevance", _sql("select scenario_id, item, rel from rel"))
def q_ranking_relevance(spark, sf_dir):
    return _evaluation(spark, sf_dir)["relevance"]


@register("ranking_recs", _sql("select scenario_id, rank, item from recs"))
def q_ranking_recs(spark, sf_dir):
    return _evaluation(spark, sf_dir)["recs"]


@register("ranking_metrics", _sql("select scenario_id, k, precision, recall, round(ndcg, 9) as ndcg, diversity from m"))
def q_ranking_metrics(spark, sf_dir):
    return rounded(_evaluation(spark, sf_dir)["metrics"], ["ndcg"])


@register("ranking_summary", _sql("""
select metric, k, round(avg(value), 9) as mean, round(stddev_pop(value), 9) as std,
       round(median(value), 9) as median, round(min(value), 9) as min, round(max(value), 9) as max
from (select k, unnest(['precision', 'recall', 'ndcg', 'diversity']) as metric,
             unnest([precision, recall, ndcg, diversity]) as value from m) group by all"""))
def q_ranking_summary(spark, sf_dir):
    return rounded(_evaluation(spark, sf_dir)["summary"], ["mean", "std", "median", "min", "max"])


@register("catalog_coverage", _sql(
    "select count(distinct item) / (select count(*) from catalogue) as catalog_coverage from recs"))
def q_catalog_coverage(spark, sf_dir):
    return _evaluation(spark, sf_dir)["coverage"]


# --- M6: similarity-based diversity of the recommendation lists ------------------------
from larder.operators.tfidf import tfidf  # noqa: E402
from larder.plans.text_queries import _CAT_TEXT, _tfidf_sql  # noqa: E402


@register("similarity_diversity", with_catalogue(
    ", cat_docs as (select code, " + _CAT_TEXT + " as text from catalogue),"
    + _tfidf_sql("cat_docs", "code", "text", 0.8, 2, 100, bigrams=True) + _EVAL_SQL + """,
fnm as (select product_name as item, min(code) as code from catalogue where product_name is not null group by 1),
rk as (select r.scenario_id, r.rank, f.code from recs r join fnm f on f.item = r.item),
pr as (select a.scenario_id, a.code as ka, b.code as kb from rk a join rk b
       on a.scenario_id = b.scenario_id and a.rank < b.rank),
sims as (select p.ka, p.kb, sum(wa.weight * wb.weight) as sim
         from (select distinct ka, kb from pr) p join w wa on wa.key = p.ka join w wb on wb.key = p.kb and wb.term = wa.term
         group by all)
select pr.scenario_id, sum(case when coalesce(s.sim, 0) < 0.7 then 1 else 0 end) * 1.0 / count(*) as similarity_diversity
from pr left join sims s on s.ka = pr.ka and s.kb = pr.kb group by pr.scenario_id""", scored=True))
def q_similarity_diversity(spark, sf_dir):
    res = _evaluation(spark, sf_dir)
    products = catalogue(spark, sf_dir)
    t = F.lower(F.coalesce(F.nullif(F.col("ingredients_text"), F.lit("")), F.lit("unknown")))
    w, _ = tfidf(products.select("code", t.alias("text")), "code", "text", max_df=0.8, min_df=2,
                 max_features=100, ngram_range=(1, 2))
    item_key = (products.where(F.col("product_name").isNotNull()).groupBy("product_name")
                .agg(F.min("code").alias("code")).withColumnRenamed("product_name", "item"))
    return R.similarity_diversity(res["recs"], item_key, w, "code")


@register("tfidf_grid")
def q_tfidf_grid(spark, sf_dir):
    """V7: all 108 configurations, scored on the first 20 scenarios."""
    products = catalogue(spark, sf_dir)
    sc = R.cut_lineage(R.create_scenarios(products))
    return R.tfidf_grid_search(products, sc, R.cut_lineage(R.relevance(products, sc)))


@register("tfidf_grid_best")
def q_tfidf_grid_best(spark, sf_dir):
    """T5: the configuration with the highest score."""
    return R.best_configuration(q_tfidf_grid(spark, sf_dir))
