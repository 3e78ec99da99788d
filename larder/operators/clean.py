"""Catalogue cleaning and filters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.functions import fixed
from larder.functions import scoring as S
from larder.functions import text as X


def irish_catalogue(df: DataFrame, limit: int | None = None) -> DataFrame:
    """P1 + P2 (+ T2): sold in Ireland (ILIKE) and non-empty ingredients.

    Both predicates are plain Column filters, so they are evaluated in the scan
    stage; the ``!= ''`` part also drops NULL text, as the remote filter did.
    The optional row cap is off by default and, when given, ordered by code
    (a deterministic top-n rather than an arbitrary sample).
    """
    out = df.where(X.sold_in_ireland_like(F.col("countries_sold")) & (F.col("ingredients_text") != ""))
    return out.orderBy("code").limit(limit) if limit else out


def coerce_nutrients(df: DataFrame, cols: Iterable[str] = ("sugar_100g", "salt_100g", "fat_100g")) -> DataFrame:
    """Unparsable / NULL / NaN nutrients become 0."""
    return df.withColumns({c: S.to_number(F.col(c)) for c in cols if c in df.columns})


def drop_foreign(df: DataFrame, keywords: Iterable[str] | None = None,
                 text_col: str = "ingredients_text") -> DataFrame:
    """P5: drop rows whose lowered text contains a foreign keyword (NULL kept)."""
    return df.where(~X.foreign_language(F.col(text_col), keywords))


def flag_concentrates(df: DataFrame) -> DataFrame:
    """P6."""
    return df.withColumn("is_soup_concentrate",
                         X.concentrate_flag(F.col("category_searched"), F.col("product_name")))


def dashboard_catalogue(df: DataFrame) -> DataFrame:
    """The dashboard's load step: P1/P2 filter, P14 coercion, P5, P6."""
    return flag_concentrates(drop_foreign(coerce_nutrients(irish_catalogue(df))))


def foreign_filter_counts(df: DataFrame, keywords: Iterable[str] | None = None) -> DataFrame:
    """P5 with the removed/remaining counts taken before and after (one pass)."""
    foreign = X.foreign_language(F.col("ingredients_text"), keywords)
    return df.agg(F.sum(F.when(foreign, 1).otherwise(0)).cast("long").alias("removed"),
                  F.sum(F.when(foreign, 0).otherwise(1)).cast("long").alias("remaining"))


def category_filter(df: DataFrame, categories: Iterable[str] | None) -> DataFrame:
    """Empty selection means no filter."""
    cats = list(categories or [])
    return df.where(F.col("category_searched").isin(cats)) if cats else df


def valid_nova(df: DataFrame, nova_col: str = "nova_group") -> DataFrame:
    """P12."""
    return df.where(F.col(nova_col).isNotNull() & (F.col(nova_col) != "unknown"))


def first_per_group(df: DataFrame, group_cols: list[str], order_cols: list, n: int = 1) -> DataFrame:
    """First ``n`` rows per group by a total order (ties broken by the
    caller's key columns); a windowed top-n that Spark plans as a per-partition
    sort after one shuffle on the group keys."""
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def why_ultra_processed(scored: DataFrame, group_cols: list[str]) -> DataFrame:
    """Per group, the first product (by code) with score > 60 and the
    first three of its additives, or the default sentence."""
    upf = scored.where(F.col("processing_score") > fixed.ULTRA_PROCESSED_THRESHOLD)
    first = first_per_group(upf, group_cols, [F.col("code")])
    return first.select(*group_cols, "code", "product_name",
                        S.why_ultra_processed(F.col("concerning_additives")).alias("why"))
