"""Table scans and the derived product catalogue.

The driver's tables hold no food catalogue, so one derived view is defined
over ``part`` with SQL text that runs unchanged in Spark and in DuckDB.  It
has NULL and duplicate names, NULL/blank ingredients, 'unknown' NOVA, nested
parentheses, E-numbers, additives, allergen statements, a synonym with a
trailing period, German rows and country variants, and it grows with ``part``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Explicit schema of the clean product table.
PRODUCT_SCHEMA = T.StructType([
    T.StructField("code", T.StringType(), False),
    T.StructField("product_name", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("nova_group", T.StringType()),
    T.StructField("ingredients_text", T.StringType()),
    T.StructField("sugar_100g", T.DoubleType()),
    T.StructField("salt_100g", T.DoubleType()),
    T.StructField("fat_100g", T.DoubleType()),
    T.StructField("countries_sold", T.StringType()),
    T.StructField("ecoscore_grade", T.StringType()),
    T.StructField("ecoscore_score", T.DoubleType()),
    T.StructField("packaging_tags", T.StringType()),
    T.StructField("origin_of_ingredients", T.StringType()),
    T.StructField("producer_link", T.StringType()),
    T.StructField("category_searched", T.StringType()),
])

# Same SQL text in Spark and DuckDB; ``{part}`` is the only placeholder.
CATALOGUE_SQL = """
select p_partkey as code, nullif(p_name, 'small ring') as product_name, p_brand as brand,
 case p_type when 'ECONOMY' then 'Soup' when 'SMALL' then 'Crisps' else p_type end as category_searched,
 case p_size % 6 when 0 then null when 5 then 'unknown' else cast(p_size % 6 as varchar(10)) end as nova_group,
 case when p_partkey % 29 = 0 then '' when p_partkey % 31 = 0 then null else concat_ws(', ', p_name,
   concat('Spices (salt, E', cast(100 + p_partkey % 900 as varchar(10)), 'a)'),
   case when p_partkey % 2 = 0 then 'Citric Acid' end, case when p_partkey % 3 = 0 then 'E330' end,
   case when p_partkey % 5 = 0 then 'PALM OIL' end, case when p_partkey % 7 = 0 then 'Contains milk' end,
   case when p_partkey % 11 = 0 then 'Glucose Syrup.' end, case when p_partkey % 13 = 0 then 'Zucker' end) end as ingredients_text,
 case when p_partkey % 17 = 0 then null else cast(p_partkey % 41 as double) end as sugar_100g,
 cast(p_partkey % 23 as double) / 10 as salt_100g, cast(p_partkey % 37 as double) as fat_100g,
 case p_partkey % 5 when 0 then 'Ireland, en:uk' when 1 then 'en:ie' when 2 then 'en:France' when 3 then 'Northern Ireland' end as countries_sold
from {part}
"""

# The catalogue as a DuckDB common-table expression for oracle queries; it
# adds the hierarchical category text used by the root-category recommender.
CATALOGUE_CTE = ("catalogue as (" + CATALOGUE_SQL.replace("{part}", "part") + ")")


# Tables whose rows carry long free text: per-row work (regex tokenising,
# splitting) dominates, so their scans must use every core.
TEXT_TABLES = frozenset({"documents", "pages", "conversations", "benchmark"})


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; callers project columns so Catalyst prunes the read.

    A text table whose scan yields fewer splits than the session's default
    parallelism (a small file with one row group) is spread round-robin
    before the per-row work; a large table already has enough splits and is
    returned untouched."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if name in TEXT_TABLES:
        target = spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < target:
            df = df.repartition(target)
    return df


#: Products, and documents, that one task works on.
PRODUCTS_PER_TASK, DOCUMENTS_PER_TASK = 25_000, 5_000


def spread(df: DataFrame, key: str, per_task: int = PRODUCTS_PER_TASK) -> DataFrame:
    """``df`` dealt by ``key`` over tasks of about ``per_task`` rows, where its
    scan yields fewer tasks: a narrow compressed table has few splits for its
    rows, and the texts and terms derived from a row are many times its size.
    Steps grouped by the key then need no further shuffle."""
    tasks = math.ceil(df.count() / per_task)
    return df.repartition(tasks, key) if tasks > df.rdd.getNumPartitions() else df


def documents_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text) dealt by the document, so that counting a document's
    terms and weighing them shuffles its text once and no (document, term)
    rows, which are several times larger."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.repartition(max(math.ceil(docs.count() / DOCUMENTS_PER_TASK), docs.rdd.getNumPartitions()), "doc_id")


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived product catalogue (code is a bigint here)."""
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    part = spread(part, "p_partkey")
    return spark.sql(CATALOGUE_SQL, part=part)


def categories_text(category, brand):
    """Hierarchical category text 'Category > Brand' (the catalogue's categories_en)."""
    from pyspark.sql import functions as F
    return F.concat_ws(" > ", category, brand)
