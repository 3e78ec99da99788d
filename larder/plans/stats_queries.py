"""Hypothesis-test queries (H1-H4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.operators import hypothesis as H
from larder.plans.registry import register
from larder.plans.sqlkit import with_catalogue
from larder.sources.tables import catalogue, read_table


def _t_sql(src: str, g: str, v: str, g1: str, g2: str, min_size: int) -> str:
    return f"""
s as (select count(case when {g} = {g1} then {v} end) as n1, avg(case when {g} = {g1} then {v} end) as mean1,
             var_samp(case when {g} = {g1} then {v} end) as var1,
             count(case when {g} = {g2} then {v} end) as n2, avg(case when {g} = {g2} then {v} end) as mean2,
             var_samp(case when {g} = {g2} then {v} end) as var2
      from {src} where {v} is not null and not isnan({v})),
c as (select *, n1 <> n2 as w, ((n1 - 1) * var1 + (n2 - 1) * var2) / (n1 + n2 - 2) as sp2,
             n1 > {min_size} and n2 > {min_size} and n1 > 1 and n2 > 1 as ok from s)
select n1, n2, mean1, mean2, case when ok then 'ok' else 'insufficient' end as status,
  case when ok then w end as welch,
  round(case when ok then (mean1 - mean2) / (case when w then sqrt(var1 / n1 + var2 / n2)
                                               else sqrt(sp2 * (1.0 / n1 + 1.0 / n2)) end) end, 9) as t,
  round(case when ok then (case when w then power(var1 / n1 + var2 / n2, 2)
                                   / (power(var1 / n1, 2) / (n1 - 1) + power(var2 / n2, 2) / (n2 - 1))
                               else cast(n1 + n2 - 2 as double) end) end, 9) as dof,
  round(case when ok then (mean1 - mean2) / sqrt(sp2) end, 9) as cohen_d
from c"""


def _round_t(df):
    return df.select("n1", "n2", "mean1", "mean2", "status", "welch", F.round("t", 9).alias("t"),
                     F.round("dof", 9).alias("dof"), F.round("cohen_d", 9).alias("cohen_d"))


def _quality_chars(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(lab, "doc_id").withColumn("n_chars", F.col("n_chars").cast("double"))


@register("ttest_quality_chars", "with d as (select cast(n_chars as double) as n_chars, quality "
          "from documents join labels using (doc_id)),"
          + _t_sql("d", "quality", "n_chars", "1", "0", 0))
def q_ttest_quality_chars(spark, sf_dir):
    summ = H.group_summary(_quality_chars(spark, sf_dir), "quality", "n_chars", 1, 0)
    return _round_t(H.ttest(summ))


@register("ttest_quality_chars_full")
def q_ttest_quality_chars_full(spark, sf_dir):
    """H1 with p-value and 95 % CI (Student-t via the helper; rows-only)."""
    summ = H.group_summary(_quality_chars(spark, sf_dir), "quality", "n_chars", 1, 0)
    return H.with_t_pvalue(H.ttest(summ))


@register("ttest_soup_crisps_sugar", with_catalogue(", " + _t_sql(
    "catalogue", "category_searched", "sugar_100g", "'Soup'", "'Crisps'", 10)[1:]))
def q_ttest_soup_crisps_sugar(spark, sf_dir):
    summ = H.group_summary(catalogue(spark, sf_dir), "category_searched", "sugar_100g", "Soup", "Crisps")
    return _round_t(H.ttest(summ, min_size=10))


@register("ttest_pooled_salt", with_catalogue(", " + _t_sql(
    "catalogue", "category_searched", "salt_100g", "'Soup'", "'Crisps'", 10)[1:].replace("n1 <> n2 as w", "false as w")))
def q_ttest_pooled_salt(spark, sf_dir):
    summ = H.group_summary(catalogue(spark, sf_dir), "category_searched", "salt_100g", "Soup", "Crisps")
    return _round_t(H.ttest(summ, welch=False, min_size=10))


_ANOVA_SQL = """
g as (select {g} as grp, count({v}) as n, avg({v}) as m, var_samp({v}) as var from {t}
      where {v} is not null and {g} is not null group by 1),
tot as (select sum(n) as nt, count(*) as k, sum(n * m) / sum(n) as grand from g)
select cast(k - 1 as bigint) as df_between, cast(nt - k as bigint) as df_within,
       round(sum(n * power(m - grand, 2)), 6) as ssb, round(sum((n - 1) * coalesce(var, 0)), 6) as ssw,
       round((sum(n * power(m - grand, 2)) / (k - 1)) / (sum((n - 1) * coalesce(var, 0)) / (nt - k)), 9) as f
from g, tot group by k, nt"""


def _round_f(df):
    return df.select("df_between", "df_within", F.round("ssb", 6).alias("ssb"), F.round("ssw", 6).alias("ssw"),
                     F.round("f", 9).alias("f"))


@register("anova_returnflag_quantity", "with " + _ANOVA_SQL.format(g="l_returnflag", v="l_quantity", t="lineitem"))
def q_anova_returnflag_quantity(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity")
    return _round_f(H.anova(li, "l_returnflag", "l_quantity"))


@register("anova_category_salt", with_catalogue(", " + _ANOVA_SQL.format(g="category_searched", v="salt_100g",
                                                                          t="catalogue")))
def q_anova_category_salt(spark, sf_dir):
    return _round_f(H.anova(catalogue(spark, sf_dir), "category_searched", "salt_100g"))


@register("anova_category_salt_full")
def q_anova_category_salt_full(spark, sf_dir):
    """H4 with the F-distribution p-value (rows-only)."""
    return H.with_f_pvalue(H.anova(catalogue(spark, sf_dir), "category_searched", "salt_100g"))


@register("group_sizes", with_catalogue(
    "select category_searched, count(sugar_100g) as n from catalogue group by category_searched"))
def q_group_sizes(spark, sf_dir):
    """H3: sample size per group of the tested value (non-NULL)."""
    return catalogue(spark, sf_dir).groupBy("category_searched").agg(F.count("sugar_100g").alias("n"))
