"""Aggregate, distribution and data-quality queries (A*, T*, U*, Q*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.operators import aggregates as A
from larder.operators import quality as Q
from larder.operators.clean import dashboard_catalogue, valid_nova
from larder.operators.scoring import score_catalogue
from larder.operators.density import density
from larder.plans.registry import register, rounded
from larder.plans.sqlkit import normalise_sql, token_ctes, with_catalogue, with_dash
from larder.sources.tables import catalogue, read_table


def _dash(spark, sf_dir):
    return dashboard_catalogue(catalogue(spark, sf_dir))


_PARSED_DASH = f""", {token_ctes('dash', 'code', 'ingredients_text')[1:]},
parsed as (select key as code, g, {normalise_sql('item')} as ingredient from t_items)"""


@register("ingredient_top20", with_dash(f"""{_PARSED_DASH}
select ingredient, count(*) as n from parsed where ingredient <> '' group by ingredient
order by n desc, ingredient limit 20"""))
def q_ingredient_top20(spark, sf_dir):
    freq = A.ingredient_frequency(_dash(spark, sf_dir))
    return A.top_n(freq, 20, [F.desc("n"), F.asc("ingredient")])


@register("ingredient_frequency", with_dash(f"""{_PARSED_DASH}
select ingredient, count(*) as n from parsed where ingredient <> '' group by ingredient"""))
def q_ingredient_frequency(spark, sf_dir):
    return A.ingredient_frequency(_dash(spark, sf_dir))


@register("dashboard_kpis", with_dash("""
select count(*) as total_products, count(distinct brand) as total_brands,
       count(distinct category_searched) as total_categories,
       sum(case when processing_score > 60 then 1 else 0 end) * 100.0 / count(*) as upf_percentage,
       avg(processing_score) as avg_processing_score, avg(e_numbers) as avg_e_numbers,
       sum(case when sugar_100g > 10 then 1 else 0 end) * 100.0 / count(*) as high_sugar_pct,
       sum(case when salt_100g > 1.5 then 1 else 0 end) * 100.0 / count(*) as high_salt_pct
from scored""", scored=True))
def q_dashboard_kpis(spark, sf_dir):
    return A.dashboard_kpis(score_catalogue(_dash(spark, sf_dir)))


@register("category_stats", with_catalogue("""
select category_searched, count(*) as product_count, round(avg(processing_score), 1) as avg_processing_score,
       min(processing_score) as min_processing_score, max(processing_score) as max_processing_score,
       round(avg(sugar_100g), 2) as avg_sugar, round(avg(salt_100g), 2) as avg_salt,
       first(product_name order by processing_score, code) as cleanest_product
from scored group by category_searched""", scored=True))
def q_category_stats(spark, sf_dir):
    return A.category_stats(score_catalogue(catalogue(spark, sf_dir)))


@register("category_top10", with_catalogue("""
select category_searched, count(*) as n from catalogue where category_searched is not null
group by category_searched order by n desc, category_searched limit 10"""))
def q_category_top10(spark, sf_dir):
    return A.value_counts(catalogue(spark, sf_dir), "category_searched", 10)


@register("sugar_by_category", with_dash(
    "select category_searched, avg(sugar_100g) as avg_sugar from dash group by category_searched"))
def q_sugar_by_category(spark, sf_dir):
    return _dash(spark, sf_dir).groupBy("category_searched").agg(F.avg("sugar_100g").alias("avg_sugar"))


@register("nutrient_means", with_dash(
    "select round(avg(sugar_100g), 9) as avg_sugar, round(avg(salt_100g), 9) as avg_salt, "
    "round(avg(fat_100g), 9) as avg_fat from dash"))
def q_nutrient_means(spark, sf_dir):
    return rounded(_dash(spark, sf_dir).agg(F.avg("sugar_100g").alias("avg_sugar"), F.avg("salt_100g").alias("avg_salt"),
                                            F.avg("fat_100g").alias("avg_fat")), ["avg_sugar", "avg_salt", "avg_fat"])


@register("category_nova_crosstab", with_catalogue("""
select category_searched,
  cast(sum(case when nova_group = '1' then 1 else 0 end) as bigint) as nova_1,
  cast(sum(case when nova_group = '2' then 1 else 0 end) as bigint) as nova_2,
  cast(sum(case when nova_group = '3' then 1 else 0 end) as bigint) as nova_3,
  cast(sum(case when nova_group = '4' then 1 else 0 end) as bigint) as nova_4
from catalogue where nova_group is not null and nova_group <> 'unknown' group by category_searched"""))
def q_category_nova_crosstab(spark, sf_dir):
    return A.crosstab(valid_nova(catalogue(spark, sf_dir)), "category_searched", "nova_group",
                      ["1", "2", "3", "4"], "nova_")


@register("nova_distribution", with_catalogue("""
select nova_group, n, n * 100.0 / total as pct from (
  select nova_group, count(*) as n, sum(count(*)) over () as total from catalogue group by nova_group)
where nova_group is not null"""))
def q_nova_distribution(spark, sf_dir):
    return A.distribution_with_share(catalogue(spark, sf_dir), "nova_group")


@register("events_overview", """
select count(*) as n_rows, count(distinct user_id) as n_distinct_keys, count(distinct event_type) as n_categories,
       min(ts) as min_ts, max(ts) as max_ts from events""")
def q_events_overview(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    return Q.overview(ev, "user_id", "event_type", "ts")


@register("nutrient_stats", with_catalogue("""
select nutrient, round(mean, 9) as mean, round(median, 9) as median, min, max, round(std, 9) as std from (
  select 'sugar_100g' as nutrient, avg(sugar_100g) as mean, median(sugar_100g) as median, min(sugar_100g) as min,
         max(sugar_100g) as max, stddev_samp(sugar_100g) as std from catalogue
  union all
  select 'salt_100g', avg(salt_100g), median(salt_100g), min(salt_100g), max(salt_100g), stddev_samp(salt_100g) from catalogue
  union all
  select 'fat_100g', avg(fat_100g), median(fat_100g), min(fat_100g), max(fat_100g), stddev_samp(fat_100g) from catalogue)"""))
def q_nutrient_stats(spark, sf_dir):
    return rounded(A.nutrient_stats(catalogue(spark, sf_dir), ["sugar_100g", "salt_100g", "fat_100g", "saturated_fat_100g"]),
                   ["mean", "median", "std"])


@register("lineitem_stats", """
select nutrient, round(mean, 9) as mean, round(median, 9) as median, min, max, round(std, 9) as std from (
  select 'l_quantity' as nutrient, avg(l_quantity) as mean, median(l_quantity) as median, min(l_quantity) as min,
         max(l_quantity) as max, stddev_samp(l_quantity) as std from lineitem
  union all
  select 'l_discount', avg(l_discount), median(l_discount), min(l_discount), max(l_discount), stddev_samp(l_discount)
  from lineitem)""")
def q_lineitem_stats(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_quantity", "l_discount")
    return rounded(A.nutrient_stats(li, ["l_quantity", "l_discount"]), ["mean", "median", "std"])


@register("salt_compare", with_dash("""
select round(soup_clean_avg, 9) as soup_clean_avg, round(crisps_avg, 9) as crisps_avg,
       round(soup_all_avg, 9) as soup_all_avg, round(soup_all_avg - soup_clean_avg, 9) as concentrate_delta,
       round((soup_all_avg - crisps_avg) / crisps_avg * 100.0, 9) as soup_vs_crisps_pct from (
  select avg(case when category_searched = 'Soup' and not is_soup_concentrate then salt_100g end) as soup_clean_avg,
         avg(case when category_searched = 'Crisps' then salt_100g end) as crisps_avg,
         avg(case when category_searched = 'Soup' then salt_100g end) as soup_all_avg from dash)"""))
def q_salt_compare(spark, sf_dir):
    return rounded(A.salt_comparison(_dash(spark, sf_dir)),
                   ["soup_clean_avg", "crisps_avg", "soup_all_avg", "concentrate_delta", "soup_vs_crisps_pct"])


_BOX_SQL = """
, q as (select {g} as grp, count({v}) as n, min({v}) as min, max({v}) as max,
              quantile_cont({v}, 0.25) as q1, quantile_cont({v}, 0.5) as median, quantile_cont({v}, 0.75) as q3
       from {t} where {v} is not null group by {g}),
  f as (select *, q3 - q1 as iqr, q1 - 1.5 * (q3 - q1) as lower_fence, q3 + 1.5 * (q3 - q1) as upper_fence from q)
select f.grp as {g}, f.n, f.min, f.max, round(f.q1, 9) as q1, round(f.median, 9) as median, round(f.q3, 9) as q3,
       round(f.iqr, 9) as iqr, round(f.lower_fence, 9) as lower_fence, round(f.upper_fence, 9) as upper_fence,
       cast(sum(case when t.{v} < f.lower_fence or t.{v} > f.upper_fence then 1 else 0 end) as bigint) as n_outliers
from f join {t} t on t.{g} = f.grp and t.{v} is not null
group by all"""


_BOX_FLOATS = ["q1", "median", "q3", "iqr", "lower_fence", "upper_fence"]


@register("salt_box_stats", with_dash(_BOX_SQL.format(g="category_searched", v="salt_100g", t="dash")))
def q_salt_box_stats(spark, sf_dir):
    return rounded(A.box_stats(_dash(spark, sf_dir), "category_searched", "salt_100g"), _BOX_FLOATS)


@register("quantity_box_stats", "with x as (select 1)" + _BOX_SQL.format(g="l_returnflag", v="l_quantity", t="lineitem"))
def q_quantity_box_stats(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity")
    return rounded(A.box_stats(li, "l_returnflag", "l_quantity"), _BOX_FLOATS)


@register("salt_histogram", with_dash("""
select category_searched, cast(floor(salt_100g / 0.5) as bigint) as bucket, count(*) as n,
       cast(floor(salt_100g / 0.5) as bigint) * cast(0.5 as double) as bucket_start
from dash where salt_100g is not null group by all"""))
def q_salt_histogram(spark, sf_dir):
    return A.histogram(_dash(spark, sf_dir), "category_searched", "salt_100g", 0.5)


_DENSITY_SQL = """, st as (select {g} as grp, count(*) as n, stddev_samp({v}) * power(count(*), -0.2) as h, min({v}) as low, max({v}) as high
       from {t} where {g} is not null and {v} is not null group by 1 having min({v}) < max({v})),
gr as (select *, low - 2 * h as lo, high - low + 4 * h as range from st),
p as (select grp, ({v} - lo) / (range / 511) as p from {t} join gr on grp = {g} where {v} is not null),
w as (select grp, bin, sum(w) as w from (select grp, floor(p) as bin, 1 - (p - floor(p)) as w from p
      union all select grp, floor(p) + 1, p - floor(p) from p) group by all),
x as (select *, unnest(range(0, 100)) as point from gr)
select x.grp as {g}, point, round(any_value(lo + point * range / 99), 9) as x,
       round(sum(w.w * exp(-0.5 * power((lo + point * range / 99 - (lo + w.bin * (range / 511))) / h, 2)))
             / any_value(n * h * sqrt(2 * pi())), 9) as density
from x join w using (grp) group by x.grp, point"""


@register("salt_density", with_dash(_DENSITY_SQL.format(g="category_searched", v="salt_100g", t="dash")))
def q_salt_density(spark, sf_dir):
    return rounded(density(_dash(spark, sf_dir), "category_searched", "salt_100g"), ["x", "density"])


@register("quantity_density", "with one as (select 1)" + _DENSITY_SQL.format(g="l_returnflag", v="l_quantity", t="lineitem"))
def q_quantity_density(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity")
    return rounded(density(li, "l_returnflag", "l_quantity"), ["x", "density"])


@register("ingredient_penetration", with_dash(f"""{_PARSED_DASH}
select ingredient, count(distinct code) as n_products,
       count(distinct code) * 100.0 / (select count(*) from dash) as pct
from parsed where ingredient <> '' group by ingredient"""))
def q_ingredient_penetration(spark, sf_dir):
    return A.ingredient_penetration(_dash(spark, sf_dir))


@register("e_number_penetration", with_dash("""
select sum(case when e_numbers >= 3 then 1 else 0 end) * 100.0 / count(*) as e3_pct,
       sum(case when processing_score > 60 then 1 else 0 end) * 100.0 / count(*) as upf_pct,
       sum(case when salt_100g > 0 and sugar_100g > 0 then 1 else 0 end) * 100.0 / count(*) as salt_and_sugar_pct
from scored""", scored=True))
def q_e_number_penetration(spark, sf_dir):
    s = score_catalogue(_dash(spark, sf_dir))
    n = F.count(F.lit(1))
    return s.agg((F.sum(F.when(F.col("e_numbers") >= 3, 1).otherwise(0)) * 100.0 / n).alias("e3_pct"),
                 (F.sum(F.when(F.col("processing_score") > 60, 1).otherwise(0)) * 100.0 / n).alias("upf_pct"),
                 (F.sum(F.when((F.col("salt_100g") > 0) & (F.col("sugar_100g") > 0), 1).otherwise(0)) * 100.0 / n)
                 .alias("salt_and_sugar_pct"))


@register("distinct_categories", with_catalogue("select distinct category_searched from catalogue"))
def q_distinct_categories(spark, sf_dir):
    return catalogue(spark, sf_dir).select("category_searched").distinct()


@register("refresh_rollup", with_catalogue("""
select category_searched, count(*) as n, cast(grouping(category_searched) as integer) as is_total
from catalogue group by rollup(category_searched)"""))
def q_refresh_rollup(spark, sf_dir):
    return A.rollup_counts(catalogue(spark, sf_dir), "category_searched")


@register("invalid_categories", with_catalogue("""
select distinct category_searched from catalogue
where category_searched not in ('Biscuits', 'Bread', 'Yogurt', 'Cereal', 'Crisps', 'Sausages', 'Jam', 'Soup',
                                'Pizza', 'Cheese', 'Soft Drinks', 'Frozen Meals')"""))
def q_invalid_categories(spark, sf_dir):
    from larder.sources.ingest import invalid_categories
    return invalid_categories(catalogue(spark, sf_dir).select("category_searched"))


# --- data quality ---------------------------------------------------------------------
@register("quality_missing", with_catalogue("""
select field, missing, missing * 100.0 / total as pct from (
  select 'product_name' as field, count(*) filter (where product_name is null) as missing, count(*) as total from catalogue
  union all select 'code', count(*) filter (where code is null), count(*) from catalogue
  union all select 'ingredients_text', count(*) filter (where ingredients_text is null), count(*) from catalogue
  union all select 'nova_group', count(*) filter (where nova_group is null), count(*) from catalogue)"""))
def q_quality_missing(spark, sf_dir):
    return Q.missing_values(catalogue(spark, sf_dir), ["product_name", "code", "ingredients_text", "nova_group"])


@register("quality_completeness", with_catalogue("""
select field, present, total, present * 100.0 / total as pct from (
  select 'salt_100g' as field, count(salt_100g) as present, count(*) as total from catalogue
  union all select 'sugar_100g', count(sugar_100g), count(*) from catalogue
  union all select 'fat_100g', count(fat_100g), count(*) from catalogue)"""))
def q_quality_completeness(spark, sf_dir):
    return Q.completeness(catalogue(spark, sf_dir),
                          ["salt_100g", "sugar_100g", "sugars_100g", "fat_100g", "saturated_fat_100g", "energy_100g"])


@register("quality_duplicates", with_catalogue(
    "select product_name, count(*) as n_rows from catalogue group by product_name having count(*) > 1"))
def q_quality_duplicates(spark, sf_dir):
    return Q.duplicate_keys(catalogue(spark, sf_dir), "product_name")


@register("quality_range", """
select 'l_quantity' as nutrient, cast(sum(case when l_quantity < 0 then 1 else 0 end) as bigint) as n_negative,
       cast(sum(case when l_quantity > 100 then 1 else 0 end) as bigint) as n_over_100 from lineitem
union all
select 'l_discount', cast(sum(case when l_discount < 0 then 1 else 0 end) as bigint),
       cast(sum(case when l_discount > 100 then 1 else 0 end) as bigint) from lineitem""")
def q_quality_range(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_quantity", "l_discount")
    return Q.range_issues(li, ["l_quantity", "l_discount"])


@register("quality_text_issues", with_catalogue("""
select cast(sum(case when nova_group is not null and ingredients_text is null then 1 else 0 end) as bigint)
         as nova_without_ingredients,
       cast(sum(case when trim(ingredients_text, E' \\t\\n\\r') = '' then 1 else 0 end) as bigint) as blank_ingredients
from catalogue"""))
def q_quality_text_issues(spark, sf_dir):
    return Q.text_issues(catalogue(spark, sf_dir))


@register("quality_recommendations", with_catalogue("""
select 'nutrient_missing_pct' as rule, f as subject, v as value, v > 50 as triggered from (
  select 'sugar_100g' as f, count(*) filter (where sugar_100g is null) * 100.0 / count(*) as v from catalogue
  union all select 'salt_100g', count(*) filter (where salt_100g is null) * 100.0 / count(*) from catalogue)
union all
select 'ingredients_missing_pct', 'ingredients_text', v, v > 30 from (
  select count(*) filter (where ingredients_text is null) * 100.0 / count(*) as v from catalogue)
union all
select 'small_categories', 'category_searched', cast(sum(case when n < 50 then 1 else 0 end) as double),
       sum(case when n < 50 then 1 else 0 end) > 0
from (select category_searched, count(*) as n from catalogue where category_searched is not null group by 1)"""))
def q_quality_recommendations(spark, sf_dir):
    return Q.recommendations(catalogue(spark, sf_dir), ["sugar_100g", "salt_100g"], "category_searched")


@register("quality_gates", with_catalogue("""
select gate, actual, threshold, case when op = '>' then actual > threshold else actual = threshold end as passed from (
  select unnest(['ingredients_complete_pct', 'nutrients_complete_pct', 'nova_complete_pct', 'negative_rows',
                 'over_100_rows']) as gate,
         unnest([ing, nut, nova, neg, over]) as actual,
         unnest([70.0, 50.0, 60.0, 0.0, 0.0]::double[]) as threshold,
         unnest(['>', '>', '>', '=', '=']) as op
  from (select
    sum(case when ingredients_text is not null and trim(ingredients_text, E' \\t\\n\\r') <> '' then 1 else 0 end) * 100.0 / count(*) as ing,
    sum(case when sugar_100g is not null and salt_100g is not null and fat_100g is not null then 1 else 0 end) * 100.0 / count(*) as nut,
    sum(case when try_cast(nova_group as integer) is not null then 1 else 0 end) * 100.0 / count(*) as nova,
    cast(sum(case when coalesce(sugar_100g < 0, false) or coalesce(salt_100g < 0, false) or coalesce(fat_100g < 0, false)
             then 1 else 0 end) as double) as neg,
    cast(sum(case when coalesce(sugar_100g > 100, false) or coalesce(salt_100g > 100, false) or coalesce(fat_100g > 100, false)
             then 1 else 0 end) as double) as over
  from catalogue))"""))
def q_quality_gates(spark, sf_dir):
    return Q.quality_gates(catalogue(spark, sf_dir), ["sugar_100g", "salt_100g", "fat_100g"])


@register("volume_gates", with_catalogue("""
select case when grouping(category_searched) = 1 then 'total' else 'category' end as scope,
       category_searched as subject, count(*) as n,
       cast(case when grouping(category_searched) = 1 then 2000 else 50 end as bigint) as low,
       cast(case when grouping(category_searched) = 1 then 2500 else 300 end as bigint) as high,
       count(*) between (case when grouping(category_searched) = 1 then 2000 else 50 end)
                    and (case when grouping(category_searched) = 1 then 2500 else 300 end) as passed
from catalogue group by rollup(category_searched)"""))
def q_volume_gates(spark, sf_dir):
    return Q.volume_gates(catalogue(spark, sf_dir), "category_searched")


@register("refresh_dry_run", with_catalogue("""
select category_searched, count(*) as n_incoming,
       category_searched in ('Biscuits', 'Bread', 'Yogurt', 'Cereal', 'Crisps', 'Sausages', 'Jam', 'Soup',
                             'Pizza', 'Cheese', 'Soft Drinks', 'Frozen Meals') as valid
from catalogue group by category_searched"""))
def q_refresh_dry_run(spark, sf_dir):
    from larder.sources.ingest import refresh_dry_run
    return refresh_dry_run(catalogue(spark, sf_dir))


@register("events_overview_approx")
def q_events_overview_approx(spark, sf_dir):
    """A10 approximate variant: HyperLogLog++ distinct counts (bounded state
    per task, mergeable partials) — rows-only, the values are estimates."""
    ev = read_table(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    return ev.agg(F.count(F.lit(1)).alias("n_rows"), F.approx_count_distinct("user_id").alias("n_distinct_keys"),
                  F.approx_count_distinct("event_type").alias("n_categories"),
                  F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"))


@register("quantity_box_stats_approx")
def q_quantity_box_stats_approx(spark, sf_dir):
    """A14 approximate variant for very large groups: ``percentile_approx``
    keeps bounded memory per group (rows-only)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity")
    return A.box_stats(li, "l_returnflag", "l_quantity", exact=False)
