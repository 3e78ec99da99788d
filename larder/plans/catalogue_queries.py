"""Catalogue queries: parsing, scoring, filters (F*, P*, S8/S9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.functions import scoring as S
from larder.functions import text as X
from larder.operators.scoring import product_analysis, score_catalogue
from larder.plans.registry import register
from larder.plans.sqlkit import badge_sql, label_sql, normalise_sql, token_ctes, with_catalogue
from larder.sources.tables import catalogue


@register("processing_score", with_catalogue(f"""
select code, product_name, category_searched, nova_label, e_numbers, n_additives, additives,
       processing_score, {badge_sql('processing_score')} as badge, {label_sql('processing_score')} as processing_label
from scored""", scored=True))
def q_processing_score(spark, sf_dir):
    df = score_catalogue(catalogue(spark, sf_dir))
    return df.select("code", "product_name", "category_searched", "nova_label", "e_numbers", "n_additives",
                     S.additive_names(F.col("concerning_additives")).alias("additives"),
                     "processing_score", "badge", "processing_label")


# --- F13 product analysis --------------------------------------------------------
@register("product_analysis", with_catalogue(f"""
select code, product_name, brand, category_searched, nova_group, nova_label, processing_score,
       {badge_sql('processing_score')} as badge, {label_sql('processing_score')} as processing_label,
       e_numbers, additives, sugar_100g, salt_100g,
       concat_ws(' || ',
         case when e_numbers > 3 then 'Contains ' || e_numbers || ' E-numbers - look for products with fewer additives' end,
         case when has_sweetener = 1 then 'Contains artificial sweeteners - try naturally sweetened alternatives' end,
         case when has_colour = 1 then 'Contains artificial colours - look for naturally coloured options' end,
         case when contains(lower(coalesce(ingredients_text, '')), 'palm oil')
              then 'Contains palm oil - consider products with other vegetable oils' end) as suggestions
from scored""", scored=True))
def q_product_analysis(spark, sf_dir):
    return product_analysis(catalogue(spark, sf_dir))


# --- F1 tokeniser ----------------------------------------------------------------
@register("tokenize", with_catalogue(f""", {token_ctes('catalogue', 'code', 'ingredients_text')[1:]}
select key as code, item from t_items"""))
def q_tokenize(spark, sf_dir):
    return catalogue(spark, sf_dir).select("code", F.explode(X.tokenize(F.col("ingredients_text"))).alias("item"))


@register("tokenize_documents", f"""with {token_ctes('documents', 'doc_id', 'text')[1:]}
select key as doc_id, item from t_items""")
def q_tokenize_documents(spark, sf_dir):
    from larder.sources.tables import read_table
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", F.explode(X.tokenize(F.col("text"))).alias("item"))


# --- F2/F3/F4 parser ----------------------------------------------------------------
def _parsed_sql(synonyms=None, prefixes=None):
    norm = normalise_sql("item", synonyms, prefixes)
    return with_catalogue(f""", {token_ctes('catalogue', 'code', 'ingredients_text')[1:]}
select code, ingredient from (select key as code, {norm} as ingredient from t_items) where ingredient <> ''""")


@register("parse_ingredients", _parsed_sql())
def q_parse_ingredients(spark, sf_dir):
    return catalogue(spark, sf_dir).select(
        "code", F.explode(X.parse_ingredients(F.col("ingredients_text"))).alias("ingredient"))


def _basic_sql():
    from larder.functions import fixed
    return _parsed_sql(fixed.BASIC_SYNONYMS, fixed.BASIC_SKIP_PREFIXES)


@register("parse_ingredients_basic", _basic_sql())
def q_parse_basic(spark, sf_dir):
    return catalogue(spark, sf_dir).select(
        "code", F.explode(X.parse_ingredients_basic(F.col("ingredients_text"))).alias("ingredient"))


# --- F5 / E1 naive split and ingredient sequences ----------------------------------
@register("ingredient_sequences", with_catalogue("""
, seqs as (select code, list_filter(list_transform(string_split(ingredients_text, ','), lambda x: lower(trim(x, E' \\t\\n\\r'))),
                                    lambda x: x <> '') as s
           from catalogue where ingredients_text is not null and ingredients_text <> '')
select code, cast(unnest(range(0, len(s))) as integer) as pos, unnest(s) as ingredient from seqs where len(s) >= 2"""))
def q_ingredient_sequences(spark, sf_dir):
    """E1 + F5: every item of every sequence in its place."""
    from larder.operators.pairs import ingredient_sequences
    return ingredient_sequences(catalogue(spark, sf_dir)).select("code", F.posexplode("sequence").alias("pos", "ingredient"))


# --- F6 ingredient count -------------------------------------------------------------
@register("ingredient_count", with_catalogue(f""", {token_ctes('catalogue', 'code', 'ingredients_text')[1:]}
select c.code, case when c.ingredients_text is null or c.ingredients_text = '' then null
                    else cast(coalesce(n.cnt, 0) as bigint) end as ingredient_count
from catalogue c left join (select key, count(*) filter (where length(item) > 2) as cnt from t_items group by key) n
  on n.key = c.code"""))
def q_ingredient_count(spark, sf_dir):
    return catalogue(spark, sf_dir).select(
        "code", X.count_ingredients(F.col("ingredients_text")).cast("long").alias("ingredient_count"))


# --- F7 / P1 / P17 countries ---------------------------------------------------------
@register("country_flags", with_catalogue("""
select code,
  case when countries_sold is null or countries_sold = '' then ''
       else array_to_string(list_transform(string_split(replace(lower(countries_sold), 'en:', ''), ','),
                                           lambda x: trim(x, E' \\t\\n\\r')), '|') end as country_list,
  (countries_sold ilike '%Ireland%' or countries_sold ilike '%en:ie%') as sold_ie_like,
  coalesce(list_contains(list_transform(string_split(replace(lower(countries_sold), 'en:', ''), ','),
                                        lambda x: trim(x, E' \\t\\n\\r')), 'ireland')
        or list_contains(list_transform(string_split(replace(lower(countries_sold), 'en:', ''), ','),
                                        lambda x: trim(x, E' \\t\\n\\r')), 'ie'), false) as sold_ie_exact
from catalogue"""))
def q_country_flags(spark, sf_dir):
    c = F.col("countries_sold")
    return catalogue(spark, sf_dir).select(
        "code", F.array_join(X.country_list(c), "|").alias("country_list"),
        X.sold_in_ireland_like(c).alias("sold_ie_like"), X.sold_in_ireland_exact(c).alias("sold_ie_exact"))


# --- P5 language filter ----------------------------------------------------------------
_FOREIGN_SQL = "coalesce(regexp_matches(lower(ingredients_text), 'zucker|wasser|spiesesalz|weizenmehl'), false)"


@register("language_filter", with_catalogue(f"select code from catalogue where not {_FOREIGN_SQL}"))
def q_language_filter(spark, sf_dir):
    from larder.operators.clean import drop_foreign
    return drop_foreign(catalogue(spark, sf_dir)).select("code")


@register("language_filter_counts", with_catalogue(f"""
select cast(sum(case when {_FOREIGN_SQL} then 1 else 0 end) as bigint) as removed,
       cast(sum(case when {_FOREIGN_SQL} then 0 else 1 end) as bigint) as remaining from catalogue"""))
def q_language_filter_counts(spark, sf_dir):
    from larder.operators.clean import foreign_filter_counts
    return foreign_filter_counts(catalogue(spark, sf_dir))


# --- P6 concentrate flag ------------------------------------------------------------------
@register("concentrate_flag", with_catalogue("""
select code, (category_searched = 'Soup' and
   coalesce(regexp_matches(lower(product_name), 'stock|pot|cube|bouillon|powder|instant|dry|mix'), false))
   as is_soup_concentrate from catalogue"""))
def q_concentrate_flag(spark, sf_dir):
    from larder.operators.clean import flag_concentrates
    return flag_concentrates(catalogue(spark, sf_dir)).select("code", "is_soup_concentrate")


# --- P7 name search (regex), S9 top-3 search, P8 ingredient search ----------------------------
@register("name_search", with_catalogue(
    "select code, product_name from catalogue where coalesce(regexp_matches(lower(product_name), 'gear|bolt'), false)"))
def q_name_search(spark, sf_dir):
    return catalogue(spark, sf_dir).where(X.name_search(F.col("product_name"), "gear|bolt")).select("code", "product_name")


@register("search_top3", with_catalogue("""
select code, product_name, nova_group, substr(ingredients_text, 1, 100) as ingredients_preview
from catalogue where contains(lower(product_name), 'widget') order by product_name, code limit 3"""))
def q_search_top3(spark, sf_dir):
    from larder.operators.aggregates import top_n
    df = catalogue(spark, sf_dir).where(X.name_search(F.col("product_name"), "widget", literal=True))
    return top_n(df, 3, ["product_name", "code"]).select(
        "code", "product_name", "nova_group", F.substring("ingredients_text", 1, 100).alias("ingredients_preview"))


@register("ingredient_search", with_catalogue(f"""
select code, product_name, processing_score, {badge_sql('processing_score')} as badge, e_numbers, additives
from scored where coalesce(regexp_matches(lower(ingredients_text), 'palm'), false) order by code limit 20""",
    scored=True))
def q_ingredient_search(spark, sf_dir):
    from larder.operators.aggregates import top_n
    df = score_catalogue(catalogue(spark, sf_dir)).where(X.name_search(F.col("ingredients_text"), "palm"))
    return top_n(df, 20, ["code"]).select(
        "code", "product_name", "processing_score", "badge", "e_numbers",
        S.additive_names(F.col("concerning_additives")).alias("additives"))


# --- S8 barcode lookup (codes derived from lineitem) ----------------------------------------
@register("barcode_lookup", with_catalogue("""
select k.code, coalesce(c.product_name, 'Unknown') as product_name, coalesce(c.brand, 'Unknown') as brand,
       coalesce(c.nova_group, 'NO DATA') as nova_group, coalesce(nullif(c.ingredients_text, ''), 'NO DATA') as ingredients,
       c.code is not null as found
from (select distinct l_partkey as code from lineitem) k left join catalogue c on c.code = k.code"""))
def q_barcode_lookup(spark, sf_dir):
    from larder.sources.lookup import barcode_lookup
    from larder.sources.tables import read_table
    codes = read_table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("code")).distinct()
    return barcode_lookup(codes, catalogue(spark, sf_dir))


# --- P10/P11/P13/P19 filters ------------------------------------------------------------------
@register("soup_salt_over", with_catalogue(
    "select code, product_name, salt_100g from catalogue where category_searched = 'Soup' and salt_100g > 2.0"))
def q_soup_salt_over(spark, sf_dir):
    df = catalogue(spark, sf_dir)
    return df.where((F.col("category_searched") == "Soup") & (F.col("salt_100g") > 2.0)).select(
        "code", "product_name", "salt_100g")


@register("biscuit_subset", with_catalogue(
    "select code from catalogue where coalesce(regexp_matches(lower(product_name), 'biscuit|cookie|cracker|gizmo'), false)"))
def q_biscuit_subset(spark, sf_dir):
    return catalogue(spark, sf_dir).where(
        X.name_search(F.col("product_name"), "biscuit|cookie|cracker|gizmo")).select("code")


@register("ultra_processed", with_catalogue("select code, processing_score from scored where processing_score > 60",
                                            scored=True))
def q_ultra_processed(spark, sf_dir):
    return score_catalogue(catalogue(spark, sf_dir)).where(F.col("processing_score") > 60).select(
        "code", "processing_score")


@register("nova4_examples", with_catalogue("""
select category_searched, code from (select *, row_number() over (partition by category_searched order by code) rn
  from catalogue where nova_group = '4') where rn <= 5"""))
def q_nova4_examples(spark, sf_dir):
    from larder.operators.clean import first_per_group
    df = catalogue(spark, sf_dir).where(F.col("nova_group") == "4")
    return first_per_group(df, ["category_searched"], [F.col("code")], 5).select("category_searched", "code")


@register("why_ultra_processed", with_catalogue("""
select category_searched, code, product_name,
       coalesce(why, 'Contains multiple E-numbers or additives.') as why from (
  select *, row_number() over (partition by category_searched order by code) rn,
         additive_details as why0 from scored where processing_score > 60) s
  left join (select code as c2, string_agg(d, '; ' order by pos) as why from (
      select c.code, a.pos, concat(array_to_string(list_transform(string_split(a.additive, ' '), lambda w: concat(upper(substr(w, 1, 1)), substr(w, 2))), ' '), ': ', a.description) d,
             row_number() over (partition by c.code order by a.pos) r
      from catalogue c join additive_dict a on contains(lower(coalesce(c.ingredients_text, '')), a.additive))
    where r <= 3 group by code) w on w.c2 = s.code
where rn = 1""", scored=True))
def q_why_ultra_processed(spark, sf_dir):
    from larder.operators.clean import why_ultra_processed
    return why_ultra_processed(score_catalogue(catalogue(spark, sf_dir)), ["category_searched"])


# --- P3 parentheses example, P9 category selection, Q1 overview -----------------------------
@register("has_parentheses", with_catalogue(
    "select code, product_name, ingredients_text from catalogue where contains(ingredients_text, '(') "
    "order by code limit 1"))
def q_has_parentheses(spark, sf_dir):
    """One product whose ingredients contain a parenthesis (first by code)."""
    from larder.operators.aggregates import top_n
    df = catalogue(spark, sf_dir).where(F.col("ingredients_text").contains("("))
    return top_n(df, 1, ["code"]).select("code", "product_name", "ingredients_text")


@register("category_filter", with_catalogue(
    "select code, category_searched from catalogue where category_searched in ('Soup', 'Crisps')"))
def q_category_filter(spark, sf_dir):
    """Multi-select of categories (an empty selection means no filter)."""
    from larder.operators.clean import category_filter
    return category_filter(catalogue(spark, sf_dir), ["Soup", "Crisps"]).select("code", "category_searched")


@register("catalogue_overview", with_catalogue("""
select count(*) as n_rows, count(distinct code) as n_distinct_keys, count(distinct category_searched) as n_categories
from catalogue"""))
def q_catalogue_overview(spark, sf_dir):
    """Q1: rows, distinct codes, categories."""
    from larder.operators.quality import overview
    return overview(catalogue(spark, sf_dir), "code", "category_searched")
