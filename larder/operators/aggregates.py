"""Aggregations.

Each is one ``groupBy``/``agg`` (partial aggregation map-side, one shuffle on
the group keys) or a global ``agg`` (partial per task, a single tiny final
merge).  Totals are computed in the same pass with conditional aggregates or
with a grouping set instead of a second scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import fixed
from larder.functions import text as X
from larder.operators.joins import size_checked_broadcast
from larder.operators.positions import exact_quantiles


def ingredient_frequency(df: DataFrame, text_col: str = "ingredients_text", parser=None) -> DataFrame:
    """A1: parsed ingredient -> number of occurrences (Counter semantics:
    an ingredient listed twice in one product counts twice)."""
    parser = parser or X.parse_ingredients
    return (df.select(F.explode(parser(F.col(text_col))).alias("ingredient"))
            .groupBy("ingredient").agg(F.count(F.lit(1)).alias("n")))


def top_n(df: DataFrame, n: int, order: Sequence) -> DataFrame:
    """Ordered top-n; Spark plans TakeOrderedAndProject (per-task
    top-n, then a merge of n rows per task)."""
    return df.orderBy(*order).limit(n)


def dashboard_kpis(scored: DataFrame) -> DataFrame:
    """A2 in one aggregate pass; percentages on an empty input are NULL."""
    n = F.count(F.lit(1))
    return scored.agg(
        n.cast("long").alias("total_products"),
        F.count_distinct("brand").cast("long").alias("total_brands"),
        F.count_distinct("category_searched").cast("long").alias("total_categories"),
        (F.sum(F.when(F.col("processing_score") > fixed.ULTRA_PROCESSED_THRESHOLD, 1).otherwise(0)) * 100.0 / n)
        .alias("upf_percentage"),
        F.avg("processing_score").alias("avg_processing_score"),
        F.avg("e_numbers").alias("avg_e_numbers"),
        (F.sum(F.when(F.col("sugar_100g") > fixed.HIGH_SUGAR_THRESHOLD, 1).otherwise(0)) * 100.0 / n)
        .alias("high_sugar_pct"),
        (F.sum(F.when(F.col("salt_100g") > fixed.HIGH_SALT_THRESHOLD, 1).otherwise(0)) * 100.0 / n)
        .alias("high_salt_pct"),
    )


def category_stats(scored: DataFrame, category_col: str = "category_searched") -> DataFrame:
    """A6 for every category at once, means rounded for display (F18: one
    decimal for scores, two for nutrients); the cleanest product is the name of the
    lowest-scoring row, ties broken by code."""
    return scored.groupBy(category_col).agg(
        F.count(F.lit(1)).cast("long").alias("product_count"),
        F.round(F.avg("processing_score"), 1).alias("avg_processing_score"),
        F.min("processing_score").alias("min_processing_score"),
        F.max("processing_score").alias("max_processing_score"),
        F.round(F.avg("sugar_100g"), 2).alias("avg_sugar"),
        F.round(F.avg("salt_100g"), 2).alias("avg_salt"),
        F.min_by("product_name", F.struct("processing_score", "code")).alias("cleanest_product"),
    )


def value_counts(df: DataFrame, col: str, n: int | None = None) -> DataFrame:
    """A3: counts per non-NULL value, descending, ties by value; optional top-n."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).cast("long").alias("n"))
    return top_n(counts, n, [F.desc("n"), F.asc(col)]) if n else counts


def distribution_with_share(df: DataFrame, col: str) -> DataFrame:
    """Count and percentage of all rows per non-NULL value.  The total
    (including NULL rows) is the sum over the grouped rows, attached as a
    one-row broadcast; the table itself is aggregated once."""
    grouped = df.groupBy(col).agg(F.count(F.lit(1)).cast("long").alias("n"))
    total = grouped.agg(F.sum("n").alias("_total"))
    return (attach_one_row(grouped, total).withColumn("pct", F.col("n") * 100.0 / F.col("_total"))
            .drop("_total").where(F.col(col).isNotNull()))


def crosstab(df: DataFrame, row_col: str, col_col: str, values: Sequence[str], prefix: str) -> DataFrame:
    """Row x column counts with fixed pivot values (no extra pass to
    discover them), zero-filled."""
    exprs = [F.sum(F.when(F.col(col_col) == v, 1).otherwise(0)).cast("long").alias(f"{prefix}{v}") for v in values]
    return df.groupBy(row_col).agg(*exprs)


def nutrient_stats(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Mean, median, min, max and sample std per nutrient.  The columns
    are unpivoted, so moments are one aggregate and medians one distributed
    quantile pass.  Columns absent from the input are skipped, as are columns
    without any value."""
    cols = [c for c in cols if c in df.columns]
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("nutrient"), F.col(c).cast("double").alias("v")) for c in cols]))
                     .alias("x")).select("x.nutrient", "x.v").where(F.col("v").isNotNull())
    moments = long.groupBy("nutrient").agg(F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"))
    middle = exact_quantiles(long, ["nutrient"], "v", [0.5])
    return moments.join(middle, "nutrient").select("nutrient", "mean", F.col("q")[0].alias("median"), "min", "max", "std")


def salt_comparison(df: DataFrame) -> DataFrame:
    """Soup (without concentrates), crisps and all-soup salt means, the
    concentrate delta and the all-soup vs crisps relative difference."""
    cat = F.col("category_searched")
    soup_clean = F.avg(F.when((cat == "Soup") & ~F.col("is_soup_concentrate"), F.col("salt_100g")))
    crisps = F.avg(F.when(cat == "Crisps", F.col("salt_100g")))
    soup_all = F.avg(F.when(cat == "Soup", F.col("salt_100g")))
    out = df.agg(soup_clean.alias("soup_clean_avg"), crisps.alias("crisps_avg"), soup_all.alias("soup_all_avg"))
    return (out.withColumn("concentrate_delta", F.col("soup_all_avg") - F.col("soup_clean_avg"))
            .withColumn("soup_vs_crisps_pct",
                        F.try_divide(F.col("soup_all_avg") - F.col("crisps_avg"), F.col("crisps_avg")) * 100.0))


def box_stats(df: DataFrame, group_col: str, value_col: str, exact: bool = True) -> DataFrame:
    """Quartiles (linear interpolation), 1.5*IQR fences and outlier count
    per group.  Exact quantiles come from counted values in a distributed
    sort; ``exact=False`` uses ``percentile_approx`` instead."""
    v = F.col(value_col)
    shares = [0.25, 0.5, 0.75]
    if exact:
        found = exact_quantiles(df, [group_col], value_col, shares)
    else:
        found = df.where(v.isNotNull()).groupBy(group_col).agg(
            F.percentile_approx(v, F.array(*map(F.lit, shares)), 10000).alias("q"), F.count(v).cast("long").alias("n"),
            F.min(v).alias("min"), F.max(v).alias("max"))
    quart = found.select(group_col, "n", "min", "max", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"),
                         F.col("q")[2].alias("q3"))
    quart = (quart.withColumn("iqr", F.col("q3") - F.col("q1"))
             .withColumn("lower_fence", F.col("q1") - 1.5 * F.col("iqr"))
             .withColumn("upper_fence", F.col("q3") + 1.5 * F.col("iqr")))
    # Outlier count: the per-group fences (one row per group) go to the rows, which
    # are counted where they lie; a join by shuffle would sort a hot group in one
    # task.  Only groups too many to broadcast are joined that way.
    quart = size_checked_broadcast(quart)
    fences = quart.select(group_col, "lower_fence", "upper_fence")
    outl = (df.where(v.isNotNull()).join(fences, group_col)
            .groupBy(group_col)
            .agg(F.sum(F.when((v < F.col("lower_fence")) | (v > F.col("upper_fence")), 1).otherwise(0))
                 .cast("long").alias("n_outliers")))
    return quart.join(outl, group_col)


def histogram(df: DataFrame, group_col: str, value_col: str, width: float) -> DataFrame:
    """Fixed-width bucket counts per group (the data behind a violin)."""
    v = F.col(value_col)
    return (df.where(v.isNotNull())
            .groupBy(group_col, F.floor(v / width).cast("long").alias("bucket"))
            .agg(F.count(F.lit(1)).cast("long").alias("n"))
            .withColumn("bucket_start", F.col("bucket") * width))


def ingredient_penetration(df: DataFrame, key: str = "code", text_col: str = "ingredients_text") -> DataFrame:
    """Share of products listing each ingredient (distinct products)."""
    total = df.agg(F.count(F.lit(1)).cast("long").alias("total"))
    per = (df.select(key, F.explode(F.array_distinct(X.parse_ingredients(F.col(text_col)))).alias("ingredient"))
           .groupBy("ingredient").agg(F.count(F.lit(1)).cast("long").alias("n_products")))
    return (attach_one_row(per, total)
            .select("ingredient", "n_products", (F.col("n_products") * 100.0 / F.col("total")).alias("pct")))


def attach_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row as a scalar
    subquery: the aggregate runs once and its values are injected into the
    projection — no join, no shuffle of ``df``."""
    cols = one_row.columns
    packed = one_row.select(F.struct(*cols).alias("_v")).scalar()
    out = df.withColumn("_one_row", packed)
    return out.select(*df.columns, *[F.col("_one_row")[c].alias(c) for c in cols])


def rollup_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts per value plus the total row (``is_total`` = 1) in one
    grouping-set aggregate."""
    return (df.rollup(col).agg(F.count(F.lit(1)).cast("long").alias("n"),
                               F.grouping(col).cast("int").alias("is_total")))
