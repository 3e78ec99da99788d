"""Recommender queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.operators.alternatives import better_alternatives, health_improvement, healthier_alternatives
from larder.operators.scoring import health_features, score_catalogue
from larder.plans.registry import register, rounded
from larder.plans.sqlkit import badge_sql, label_sql, token_ctes, with_catalogue
from larder.sources.tables import catalogue, categories_text


def _alt_sql(same_category: bool, n: int) -> str:
    scope = "and c.category_searched = p.category_searched" if same_category else ""
    return with_catalogue(f""",
cand as (
  select p.code, c.code as alt_code, c.processing_score as alt_score,
         p.processing_score - c.processing_score as score_improvement,
         c.processing_score < p.processing_score as strict
  from scored p join scored c on c.processing_score <= p.processing_score {scope}
  where not (p.product_name is not null and c.product_name is not null and c.product_name = p.product_name)),
flag as (select *, max(case when strict then 1 else 0 end) over (partition by code) as has_strict from cand),
ranked as (select *, row_number() over (partition by code order by alt_score, alt_code) as rank
           from flag where strict or has_strict = 0)
select code, rank, alt_code, alt_score, score_improvement from ranked where rank <= {n}""", scored=True)


def _alternatives(spark, sf_dir, same_category: bool, n: int):
    alts = healthier_alternatives(score_catalogue(catalogue(spark, sf_dir)), top_n=n,
                                  same_category_only=same_category)
    return alts


@register("alternatives_top3", _alt_sql(True, 3))
def q_alternatives_top3(spark, sf_dir):
    return _alternatives(spark, sf_dir, True, 3).select("code", "rank", "alt_code", "alt_score", "score_improvement")


@register("alternatives_top20", _alt_sql(True, 20))
def q_alternatives_top20(spark, sf_dir):
    return _alternatives(spark, sf_dir, True, 20).select("code", "rank", "alt_code", "alt_score", "score_improvement")


@register("alternatives_global", _alt_sql(False, 3))
def q_alternatives_global(spark, sf_dir):
    return _alternatives(spark, sf_dir, False, 3).select("code", "rank", "alt_code", "alt_score", "score_improvement")


def _detail_sql() -> str:
    base = _alt_sql(True, 3)
    head, tail = base.rsplit("select code, rank, alt_code, alt_score, score_improvement from ranked where rank <= 3", 1)
    return head + f"""select r.code, r.rank, r.alt_code, c.product_name as alt_name, c.category_searched as alt_category,
       r.alt_score, r.score_improvement, {badge_sql('r.alt_score')} as alt_badge,
       {label_sql('r.alt_score')} as alt_label, c.nova_label as alt_nova_label, c.e_numbers as alt_e_numbers,
       c.sugar_100g as alt_sugar_100g, c.salt_100g as alt_salt_100g, c.brand as alt_brand
from ranked r join scored c on c.code = r.alt_code where r.rank <= 3""" + tail


@register("alternatives_detail", _detail_sql())
def q_alternatives_detail(spark, sf_dir):
    """Flagship display form: every product with its top-3 alternatives and
    their badge, label, NOVA label, E-numbers, nutrients and brand."""
    return _alternatives(spark, sf_dir, True, 3)


# --- healthiness model ------------------------------------------------------------------
_FEATURES_SQL = f""",
{token_ctes('catalogue', 'code', 'ingredients_text')[1:]},
cnt as (select key, count(*) filter (where length(item) > 2) as c from t_items group by key),
feat0 as (
  select s.code, s.product_name, concat_ws(' > ', s.category_searched, s.brand) as categories_en, s.countries_sold,
         case when s.ingredients_text is null or s.ingredients_text = '' then null
              else cast(coalesce(cnt.c, 0) as bigint) end as ingredient_count,
         cast(s.nova_i as bigint) as nova_int, s.e_numbers, s.n_additives
  from scored s left join cnt on cnt.key = s.code),
feat as (
  select *, cast(2 * least(coalesce(ingredient_count, 20), 20) + 10 * (coalesce(nova_int, 4) - 1)
                 + 2 * least(e_numbers, 10) + 2 * least(n_additives, 5) as double) as healthiness_score
  from feat0),
tgt as (select *, case when categories_en is null or categories_en = '' then ''
                       else trim(split_part(categories_en, '>', 1)) end as root from feat),
pairs as (
  select t.code, c.code as alt_code, c.product_name as alt_name, c.ingredient_count as alt_ingredient_count,
         c.nova_int as alt_nova, c.healthiness_score as alt_healthiness,
         t.healthiness_score - c.healthiness_score as improvement,
         round((t.healthiness_score - c.healthiness_score) * 100.0 / t.healthiness_score, 1) as improvement_pct,
         coalesce(t.ingredient_count, 20) as t_cnt, coalesce(c.ingredient_count, 20) as a_cnt,
         coalesce(t.nova_int, 4) as t_nova, coalesce(c.nova_int, 4) as a_nova, t.e_numbers as t_e, c.e_numbers as a_e
  from tgt t join feat c
    on contains(lower(c.categories_en), lower(t.root))
   and coalesce(contains(lower(c.countries_sold), 'ireland'), false)
   and c.code <> t.code and c.healthiness_score < t.healthiness_score),
ranked as (select *, row_number() over (partition by code order by alt_healthiness, alt_code) as rank from pairs)"""


@register("better_alternatives", with_catalogue(_FEATURES_SQL + """
select code, rank, alt_code, alt_name, alt_ingredient_count, alt_nova, alt_healthiness, improvement, improvement_pct,
       coalesce(nullif(concat_ws(' | ',
         case when a_cnt < t_cnt then (t_cnt - a_cnt) || ' fewer ingredients' end,
         case when a_nova < t_nova then 'Less processed (NOVA ' || a_nova || ' vs ' || t_nova || ')' end,
         case when a_e < t_e then (t_e - a_e) || ' fewer E-numbers' end), ''), 'Similar processing, different brand')
         as why_better
from ranked where rank <= 10""", scored=True))
def q_better_alternatives(spark, sf_dir):
    return better_alternatives(_features(spark, sf_dir), top_n=10)


def _features(spark, sf_dir):
    cat = catalogue(spark, sf_dir)
    cat = cat.withColumn("categories_en", categories_text(F.col("category_searched"), F.col("brand")))
    return health_features(cat)


@register("health_improvement", with_catalogue(_FEATURES_SQL + """,
top as (select * from ranked where rank <= 10),
per as (select p.code, avg(p.a_cnt) as m_cnt, avg(p.a_nova) as m_nova, avg(p.a_e) as m_e, avg(p.improvement) as m_imp,
               any_value(p.t_cnt) as t_cnt, any_value(p.t_nova) as t_nova, any_value(p.t_e) as t_e
        from top p group by p.code)
select round(avg(t_cnt - m_cnt), 9) as avg_ingredient_reduction, round(avg(t_nova - m_nova), 9) as avg_nova_improvement,
       round(avg(t_e - m_e), 9) as avg_e_number_reduction, round(avg(m_imp), 9) as avg_score_improvement,
       (select count(*) from feat) as n_tested
from per""", scored=True))
def q_health_improvement(spark, sf_dir):
    feats = _features(spark, sf_dir)
    return rounded(health_improvement(feats, top_n=10), ["avg_ingredient_reduction", "avg_nova_improvement",
                                                     "avg_e_number_reduction", "avg_score_improvement"])


@register("healthiness_score", with_catalogue(_FEATURES_SQL + """
select code, ingredient_count, nova_int, e_numbers, n_additives, healthiness_score from feat""", scored=True))
def q_healthiness_score(spark, sf_dir):
    return _features(spark, sf_dir).select("code", "ingredient_count", "nova_int", "e_numbers", "n_additives",
                                           "healthiness_score")
