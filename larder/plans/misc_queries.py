"""Index encoding (E7) and the display projection."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.functions import text as X
from larder.operators.pairs import category_index, product_index
from larder.operators.scoring import score_catalogue
from larder.plans.registry import register
from larder.plans.sqlkit import badge_sql, label_sql, with_catalogue
from larder.sources.tables import catalogue


@register("product_index", with_catalogue("""
select product_name, max(pos) as product_idx from (
  select product_name, row_number() over (order by code) - 1 as pos from catalogue)
where product_name is not null group by product_name"""))
def q_product_index(spark, sf_dir):
    return product_index(catalogue(spark, sf_dir))


@register("category_index", with_catalogue("""
select category_searched, row_number() over (order by first_key) - 1 as category_idx from (
  select category_searched, min(code) as first_key from catalogue group by category_searched)"""))
def q_category_index(spark, sf_dir):
    return category_index(catalogue(spark, sf_dir))


@register("product_display", with_catalogue(f"""
select code as "Code", product_name as "Product", brand as "Brand", category_searched as "Category",
       nova_label as "NOVA", processing_score as "Processing Score",
       {badge_sql('processing_score')} || ' ' || {label_sql('processing_score')} as "Processing",
       e_numbers as "E-numbers", coalesce(additive_details, '') as "Additives",
       (coalesce(regexp_matches(product_name, '(?i)gluten[- ]free'), false)
        or coalesce(regexp_matches(ingredients_text, '(?i)gluten[- ]free'), false)) as "Gluten Free"
from scored""", scored=True))
def q_product_display(spark, sf_dir):
    """P16 renamed display columns, F19 title-cased additive names, F17 flag."""
    s = score_catalogue(catalogue(spark, sf_dir))
    adds = F.array_join(F.transform(F.col("concerning_additives"),
                                    lambda x: F.concat(F.initcap(x["additive"]), F.lit(": "), x["description"])), "; ")
    out = s.select("code", "product_name", "brand", "category_searched", "nova_label", "processing_score",
                   F.concat_ws(" ", "badge", "processing_label").alias("processing"), "e_numbers",
                   adds.alias("additives"),
                   X.gluten_free_flag(F.col("product_name"), F.col("ingredients_text")).alias("gluten_free"))
    return out.withColumnsRenamed({
        "code": "Code", "product_name": "Product", "brand": "Brand", "category_searched": "Category",
        "nova_label": "NOVA", "processing_score": "Processing Score", "processing": "Processing",
        "e_numbers": "E-numbers", "additives": "Additives", "gluten_free": "Gluten Free"})
