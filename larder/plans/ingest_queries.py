"""Ingest queries on the ``events`` table: JSON extraction and upsert."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.plans.registry import register
from larder.plans.sqlkit import with_catalogue
from larder.sources import ingest as I
from larder.sources.tables import read_table

# Table state before the incremental batch = events before this instant; the
# batch = events from it on.  Both halves together are the whole table.
CUT = "2024-01-16 00:00:00"


@register("events_props", """
select event_id, try_cast(json_extract_string(props, '$.k') as bigint) as k from events""")
def q_events_props(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id", "props")
    return I.extract_json_field(ev, "props", "k", "k").select("event_id", "k")


@register("events_latest", """
select user_id, event_id, ts, event_type, value from (
  select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1""")
def q_events_latest(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return I.latest_per_key(ev, "user_id", ["ts", "event_id"])


@register("events_upsert", f"""
with existing as (
  select user_id, event_id, ts, event_type, value from (
    select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
    from events where ts < timestamp '{CUT}') where rn = 1),
incoming as (
  select user_id, event_id, ts, event_type, value from (
    select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
    from events where ts >= timestamp '{CUT}') where rn = 1)
select * from existing where user_id not in (select user_id from incoming)
union all select * from incoming""")
def q_events_upsert(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    cut = F.lit(CUT).cast(ev.schema["ts"].dataType)
    existing = I.latest_per_key(ev.where(F.col("ts") < cut), "user_id", ["ts", "event_id"])
    incoming = ev.where(F.col("ts") >= cut)
    return I.upsert(existing, incoming, "user_id", ["ts", "event_id"])


@register("landed_pages_ingest", with_catalogue("""
select cast(code as varchar) as code, coalesce(nullif(product_name, ''), 'Unknown') as product_name,
       coalesce(nullif(brand, ''), 'Unknown') as brand, nova_group,
       coalesce(sugar_100g, 0.0) as sugar_100g, coalesce(salt_100g, 0.0) as salt_100g,
       coalesce(fat_100g, 0.0) as fat_100g, coalesce(nullif(countries_sold, ''), 'Unknown') as countries_sold,
       category_searched
from catalogue where coalesce(ingredients_text, '') <> ''"""))
def q_landed_pages_ingest(spark, sf_dir):
    """S10 + S2 + P4 + P15 + S4: land the catalogue as nested JSON pages under
    the shared checkpoint folder, then ingest them with the explicit schema
    (cleaned, de-duplicated by code)."""
    import uuid

    from larder.session import ensure_checkpoint_dir
    from larder.sources.tables import catalogue
    landing = f"{ensure_checkpoint_dir(spark).rstrip('/')}/landing-{uuid.uuid4().hex}"
    I.land_pages(catalogue(spark, sf_dir), landing)
    clean = I.ingest_pages(spark, landing)
    return clean.select("code", "product_name", "brand", "nova_group", "sugar_100g", "salt_100g", "fat_100g",
                        "countries_sold", "category_searched")


# Incoming rows of a refresh: every fourth product comes again, some of them
# under another category, and every twelfth on two pages (the later one wins).
_INCOMING = """incoming as (
  select code, concat('new ', coalesce(product_name, 'none')) as product_name,
         case when code % 8 = 0 then 'Soup' else category_searched end as category_searched, sugar_100g, 2 as page
  from catalogue where code % 4 = 0
  union all
  select code, 'old page', category_searched, sugar_100g, 1 from catalogue where code % 12 = 0)"""
_FRESH = """fresh as (select code, product_name, category_searched, sugar_100g from (
  select *, row_number() over (partition by code order by page desc) as rn from incoming{where}) where rn = 1)"""
REFRESHED = ("Soup", "Crisps")


def _refresh_inputs(spark, sf_dir):
    from larder.sources.tables import catalogue
    existing = catalogue(spark, sf_dir).select("code", "product_name", "category_searched", "sugar_100g")
    code, category = F.col("code"), F.col("category_searched")
    again = existing.where(code % 4 == 0).withColumns({
        "product_name": F.concat(F.lit("new "), F.coalesce("product_name", F.lit("none"))),
        "category_searched": F.when(code % 8 == 0, "Soup").otherwise(category), "page": F.lit(2)})
    earlier = existing.where(code % 12 == 0).withColumns({"product_name": F.lit("old page"), "page": F.lit(1)})
    return existing, again.unionByName(earlier)


@register("refresh_scoped", with_catalogue(f""", {_INCOMING},
{_FRESH.format(where=f" where category_searched in {REFRESHED}")}
select code, product_name, category_searched, sugar_100g from catalogue
where category_searched not in (select category_searched from fresh) and code not in (select code from fresh)
union all select * from fresh"""))
def q_refresh_scoped(spark, sf_dir):
    """Only the chosen categories are replaced; a product that moved into
    one of them does not stay in its old one."""
    existing, incoming = _refresh_inputs(spark, sf_dir)
    return I.refresh(existing, incoming, REFRESHED)


@register("refresh_full", with_catalogue(f""", {_INCOMING},
{_FRESH.format(where="")}
select * from fresh"""))
def q_refresh_full(spark, sf_dir):
    existing, incoming = _refresh_inputs(spark, sf_dir)
    return I.refresh(existing, incoming, full_refresh=True).select("code", "product_name", "category_searched", "sugar_100g")


_CSV_SQL = with_catalogue("""
select cast(code as varchar) as code, product_name, brand, nova_group, ingredients_text, sugar_100g, salt_100g, fat_100g,
       countries_sold, category_searched from catalogue""")


def _scratch(spark, label):
    import uuid

    from larder.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


@register("csv_round_trip", _CSV_SQL)
def q_csv_round_trip(spark, sf_dir):
    """S6 + S3: the catalogue exported as CSV and read back with the schema."""
    from larder.sources.tables import PRODUCT_SCHEMA, catalogue
    cat = catalogue(spark, sf_dir).withColumn("code", F.col("code").cast("string"))
    full = cat.select(*[F.col(f.name) if f.name in cat.columns else F.lit(None).cast(f.dataType).alias(f.name)
                        for f in PRODUCT_SCHEMA])
    path = _scratch(spark, "csv")
    I.write_csv(full, path)
    return I.read_products_csv(spark, path).select("code", "product_name", "brand", "nova_group", "ingredients_text", "sugar_100g",
                                                   "salt_100g", "fat_100g", "countries_sold", "category_searched")


@register("report_round_trip", with_catalogue("""
select category_searched, count(*) as n, cast(grouping(category_searched) as integer) as is_total
from catalogue group by rollup(category_searched)"""))
def q_report_round_trip(spark, sf_dir):
    """The update log written as JSON and read back."""
    from larder.sources.tables import catalogue
    path = _scratch(spark, "report")
    log = I.update_log(catalogue(spark, sf_dir))
    I.write_report(log, path)
    return spark.read.schema(log.schema).json(path).select("category_searched", "n", F.col("is_total").cast("int").alias("is_total"))


@register("capped_catalogue", with_catalogue("""
select code, product_name, category_searched from catalogue
where (countries_sold ilike '%Ireland%' or countries_sold ilike '%en:ie%') and ingredients_text <> ''
order by code limit 100"""))
def q_capped_catalogue(spark, sf_dir):
    """The ordered row cap of the dashboard's load (a feature: first 100 by code)."""
    from larder.operators.clean import irish_catalogue
    from larder.sources.tables import catalogue
    return irish_catalogue(catalogue(spark, sf_dir), limit=100).select("code", "product_name", "category_searched")
