"""Ingest, upsert, refresh and sinks.

HTTP harvesting is not rebuilt: pages are expected as landed JSON files
(``landing/category=<name>/page=<n>/*.json``) and read with an explicit schema.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions import fixed
from larder.functions import scoring as S
from larder.operators.positions import position_index
from larder.sources.tables import PRODUCT_SCHEMA

# Raw product document as returned by the product API (nested nutriments).
RAW_PRODUCT_SCHEMA = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("brands", T.StringType()),
    T.StructField("nova_group", T.StringType()),
    T.StructField("ingredients_text", T.StringType()),
    T.StructField("nutriments", T.StructType([
        T.StructField("sugars_100g", T.StringType()),
        T.StructField("salt_100g", T.StringType()),
        T.StructField("fat_100g", T.StringType()),
    ])),
    T.StructField("countries", T.StringType()),
    T.StructField("ecoscore_grade", T.StringType()),
    T.StructField("ecoscore_score", T.StringType()),
    T.StructField("packaging", T.StringType()),
    T.StructField("origins", T.StringType()),
    T.StructField("link", T.StringType()),
])


def _blank_to(col, default: str):
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isNull() | (c == ""), F.lit(default)).otherwise(c)


def clean_raw_products(raw: DataFrame, category_col: str = "category", keep: Iterable[str] = ()) -> DataFrame:
    """S2 + P4 + P15: flatten the nested document into the clean schema.

    Rows without a code or without ingredients are skipped; falsy nutrients
    become 0.0; falsy names/brands 'Unknown'; ecoscore 0/absent -> NULL."""
    kept = raw.where(F.coalesce(F.col("code"), F.lit("")) != "").where(
        F.coalesce(F.col("ingredients_text"), F.lit("")) != "")
    eco = F.col("ecoscore_score").cast("string").try_cast("double")
    return kept.select(
        F.col("code"),
        _blank_to("product_name", "Unknown").alias("product_name"),
        _blank_to("brands", "Unknown").alias("brand"),
        F.col("nova_group").cast("string").alias("nova_group"),
        F.col("ingredients_text"),
        S.falsy_to_zero(F.col("nutriments.sugars_100g")).alias("sugar_100g"),
        S.falsy_to_zero(F.col("nutriments.salt_100g")).alias("salt_100g"),
        S.falsy_to_zero(F.col("nutriments.fat_100g")).alias("fat_100g"),
        _blank_to("countries", "Unknown").alias("countries_sold"),
        _blank_to("ecoscore_grade", "unknown").alias("ecoscore_grade"),
        F.when(eco == 0, F.lit(None).cast("double")).otherwise(eco).alias("ecoscore_score"),
        _blank_to("packaging", "Unknown").alias("packaging_tags"),
        _blank_to("origins", "Unknown").alias("origin_of_ingredients"),
        F.coalesce(F.col("link"), F.lit("")).alias("producer_link"),
        F.col(category_col).cast("string").alias("category_searched"),
        *[F.col(c) for c in keep],
    )


def read_landed_pages(spark: SparkSession, landing: str) -> DataFrame:
    """Landed page files; partition discovery yields ``category`` and
    ``page`` columns; each file holds JSON lines of raw products."""
    schema = T.StructType(RAW_PRODUCT_SCHEMA.fields + [
        T.StructField("category", T.StringType()), T.StructField("page", T.IntegerType())])
    return spark.read.schema(schema).json(landing)


def ingest_pages(spark: SparkSession, landing: str, existing: DataFrame | None = None) -> DataFrame:
    """S10 -> S2/P4/P15 -> S4: clean every landed page and upsert by code; a
    code landed more than once keeps its row from the highest page (then
    category) — the last write of the harvest loop."""
    clean = clean_raw_products(read_landed_pages(spark, landing), keep=["page"])
    fresh = latest_per_key(clean, "code", ["page", "category_searched"]).drop("page")
    if existing is None:
        return fresh
    return existing.join(fresh.select("code"), "code", "left_anti").unionByName(fresh.select(*existing.columns))


def read_products_csv(spark: SparkSession, path: str) -> DataFrame:
    """S3: CSV export read back with the explicit schema; an absent file
    gives an empty frame, any other error is raised.  Quotes inside a value
    are doubled, as ``write_csv`` writes them; an empty quoted value is an
    empty string and an unquoted one NULL."""
    reader = spark.read.schema(PRODUCT_SCHEMA).options(header=True, escape='"', multiLine=True, emptyValue="", nullValue=None)
    try:
        return reader.csv(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PRODUCT_SCHEMA)


def extract_json_field(df: DataFrame, json_col: str, field: str, alias: str, cast: str = "long") -> DataFrame:
    """F20/S2 on JSON text: ``get_json_object`` with a cast (NULL if absent)."""
    return df.withColumn(alias, F.get_json_object(F.col(json_col), f"$.{field}").try_cast(cast))


def latest_per_key(df: DataFrame, key: str, order_cols: Iterable[str]) -> DataFrame:
    """The last row per key by ``order_cols`` (ingest order).  One shuffle
    on the key; ``max_by`` over a struct keeps it a hash aggregate (no sort)."""
    order_cols = list(order_cols)
    others = [c for c in df.columns if c != key]
    agg = df.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(*order_cols)).alias("_r"))
    return agg.select(key, *[F.col(f"_r.{c}").alias(c) for c in others])


def upsert(existing: DataFrame, incoming: DataFrame, key: str, order_cols: Iterable[str]) -> DataFrame:
    """Incoming rows de-duplicated by key (last wins), replacing existing
    rows with the same key.  Anti join + union: one shuffle on ``key`` per
    side; a new table version is written by the caller."""
    fresh = latest_per_key(incoming, key, order_cols)
    kept = existing.join(fresh.select(key), key, "left_anti")
    return kept.unionByName(fresh)


def invalid_categories(requested: DataFrame, col: str = "category_searched",
                       allowed: Iterable[str] = fixed.SEARCH_CATEGORIES) -> DataFrame:
    """Requested categories not on the allow-list (distinct)."""
    return requested.select(col).distinct().where(~F.col(col).isin(list(allowed)))


def refresh(existing: DataFrame, incoming: DataFrame, categories: Iterable[str] | None = None,
            full_refresh: bool = False, key: str = "code", order_cols: Iterable[str] = ("page",)) -> DataFrame:
    """The table after a refresh.

    Full refresh: the new table is exactly the (de-duplicated) incoming rows.
    Category-scoped: rows of the refreshed categories are replaced by the
    incoming rows of those categories.  Other categories are untouched, but
    for products that have moved into a refreshed one: a key stays unique."""
    cats = list(categories or [])
    inc = incoming.where(F.col("category_searched").isin(cats)) if cats else incoming
    fresh = latest_per_key(inc, key, order_cols)
    if full_refresh:
        return fresh
    refreshed = fresh.select("category_searched").distinct()
    others = (existing.join(refreshed, "category_searched", "left_anti")
              .join(fresh.select(key), key, "left_anti"))
    return others.unionByName(fresh.select(*existing.columns))


def write_catalogue(df: DataFrame, path: str, dynamic: bool = True) -> None:
    """S5 sink: Parquet partitioned by category; dynamic partition overwrite
    replaces only the categories present in ``df``."""
    mode = "dynamic" if dynamic else "static"
    df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("category_searched").parquet(path)


def update_log(df: DataFrame) -> DataFrame:
    """S7 update log: counts per category plus the total row."""
    return (df.rollup("category_searched").agg(F.count(F.lit(1)).cast("long").alias("n"),
                                               F.grouping("category_searched").alias("is_total"))
            .withColumn("logged_at", F.current_timestamp()))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV export with a header; see ``read_products_csv``."""
    df.write.mode("overwrite").options(header=True, escape='"', emptyValue='""').csv(path)


def write_report(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Write a report DataFrame (quality sections, logs)."""
    df.write.mode("overwrite").format(fmt).save(path)


def land_pages(products: DataFrame, landing: str, page_size: int = 50) -> None:
    """Write products as raw nested JSON documents into
    ``landing/category=<c>/page=<n>/`` (the shape the harvest receives), so
    ingest can be exercised from tables.  Page numbers follow key order
    within a category: ``floor(rank / page_size) + 1``.  Ranks are positions
    in a range-partitioned sort less the category's first position, so a
    category that holds most rows is numbered by many tasks."""
    placed = position_index(products, ["category_searched", "code"])
    firsts = placed.groupBy("category_searched").agg(F.min("pos").alias("first"))
    ranked = placed.join(firsts, placed["category_searched"].eqNullSafe(firsts["category_searched"])).drop(firsts["category_searched"])
    raw = ranked.select(
        F.col("code").cast("string").alias("code"), "product_name", F.col("brand").alias("brands"),
        "nova_group", "ingredients_text",
        F.struct(F.col("sugar_100g").cast("string").alias("sugars_100g"),
                 F.col("salt_100g").cast("string").alias("salt_100g"),
                 F.col("fat_100g").cast("string").alias("fat_100g")).alias("nutriments"),
        F.col("countries_sold").alias("countries"),
        F.col("category_searched").alias("category"),
        (F.floor((F.col("pos") - F.col("first")) / page_size) + 1).cast("int").alias("page"))
    raw.write.mode("overwrite").partitionBy("category", "page").json(landing)


def refresh_dry_run(incoming: DataFrame, categories: Iterable[str] | None = None,
                    allowed: Iterable[str] = fixed.SEARCH_CATEGORIES) -> DataFrame:
    """S5 dry run: what a refresh would do, without writing — rows per
    requested category, and whether the category is on the allow-list.
    No categories means every category present in the batch."""
    cats = list(categories or [])
    inc = incoming.where(F.col("category_searched").isin(cats)) if cats else incoming
    counts = inc.groupBy("category_searched").agg(F.count(F.lit(1)).cast("long").alias("n_incoming"))
    return counts.withColumn("valid", F.col("category_searched").isin(list(allowed)))
