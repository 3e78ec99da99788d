"""Data-quality report (Q1-Q9, S7) as DataFrames.

Every check is a conditional aggregate, so the whole report needs one scan
for the column checks plus one ``groupBy`` for per-key checks; results are
long tables ``(check, ...)`` that can be written as JSON/Parquet.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions import fixed


def _is_missing(df: DataFrame, c: str):
    col = F.col(c)
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def _stack(wide: DataFrame, names: Sequence[str], value_cols: Sequence[Sequence[str]], out_cols: Sequence[str]) -> DataFrame:
    args = ", ".join("'" + n + "', " + ", ".join(f"`{v}`" for v in vs) for n, vs in zip(names, value_cols))
    return wide.selectExpr(f"stack({len(names)}, {args}) as ({', '.join(out_cols)})")


def missing_values(df: DataFrame, fields: Iterable[str]) -> DataFrame:
    """Q2: missing count and percentage per field present in the input."""
    fields = [f for f in fields if f in df.columns]
    n = F.count(F.lit(1))
    wide = df.agg(n.cast("long").alias("_n"), *[
        F.sum(F.when(_is_missing(df, f), 1).otherwise(0)).cast("long").alias(f"{f}__m") for f in fields])
    long = _stack(wide, fields, [[f"{f}__m", "_n"] for f in fields], ["field", "missing", "total"])
    return long.select("field", "missing", F.try_divide(F.col("missing") * 100.0, F.col("total")).alias("pct"))


def completeness(df: DataFrame, fields: Iterable[str]) -> DataFrame:
    """Q3: present count and percentage per nutrient present in the input."""
    fields = [f for f in fields if f in df.columns]
    n = F.count(F.lit(1))
    wide = df.agg(n.cast("long").alias("_n"), *[
        F.sum(F.when(_is_missing(df, f), 0).otherwise(1)).cast("long").alias(f"{f}__p") for f in fields])
    long = _stack(wide, fields, [[f"{f}__p", "_n"] for f in fields], ["field", "present", "total"])
    return long.select("field", "present", "total",
                       F.try_divide(F.col("present") * 100.0, F.col("total")).alias("pct"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Q4: keys held by more than one row (``keep=False`` semantics: every
    row of such a group is a duplicate); NULL keys group together.  One
    shuffle on the key with map-side partial counts."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).cast("long").alias("n_rows"))
            .where(F.col("n_rows") > 1))


def range_issues(df: DataFrame, cols: Iterable[str], upper: float = 100.0) -> DataFrame:
    """Q5: negative values and values above ``upper`` g/100 g per nutrient."""
    cols = [c for c in cols if c in df.columns]
    aggs = []
    for c in cols:
        aggs += [F.sum(F.when(F.col(c) < 0, 1).otherwise(0)).cast("long").alias(f"{c}__neg"),
                 F.sum(F.when(F.col(c) > upper, 1).otherwise(0)).cast("long").alias(f"{c}__over")]
    wide = df.agg(*aggs)
    return _stack(wide, cols, [[f"{c}__neg", f"{c}__over"] for c in cols], ["nutrient", "n_negative", "n_over_100"])


def text_issues(df: DataFrame, nova_col: str = "nova_group", text_col: str = "ingredients_text") -> DataFrame:
    """Q6: NOVA present but ingredients NULL; blank (whitespace-only) ingredients."""
    t = F.col(text_col)
    return df.agg(
        F.sum(F.when(F.col(nova_col).isNotNull() & t.isNull(), 1).otherwise(0)).cast("long").alias("nova_without_ingredients"),
        F.sum(F.when(F.regexp_replace(t, fixed.UNICODE_TRIM_PATTERN, "") == "", 1).otherwise(0)).cast("long")
        .alias("blank_ingredients"),
    )


def recommendations(df: DataFrame, nutrient_fields: Iterable[str], category_col: str,
                    text_col: str = "ingredients_text") -> DataFrame:
    """Q7: rule outcomes as rows (rule, subject, value, triggered)."""
    miss = missing_values(df, list(nutrient_fields) + [text_col])
    nut = miss.where(F.col("field") != text_col).select(
        F.lit("nutrient_missing_pct").alias("rule"), F.col("field").alias("subject"), F.col("pct").alias("value"),
        (F.col("pct") > fixed.MISSING_NUTRIENT_WARN_PCT).alias("triggered"))
    ing = miss.where(F.col("field") == text_col).select(
        F.lit("ingredients_missing_pct").alias("rule"), F.col("field").alias("subject"), F.col("pct").alias("value"),
        (F.col("pct") > fixed.MISSING_INGREDIENT_WARN_PCT).alias("triggered"))
    counts = df.where(F.col(category_col).isNotNull()).groupBy(category_col).count()
    small = counts.agg(F.sum(F.when(F.col("count") < fixed.SMALL_CATEGORY_MIN, 1).otherwise(0)).cast("double")
                       .alias("value")).select(
        F.lit("small_categories").alias("rule"), F.lit(category_col).alias("subject"), "value",
        (F.col("value") > 0).alias("triggered"))
    return nut.unionByName(ing).unionByName(small)


def quality_gates(df: DataFrame, nutrient_cols: Sequence[str], nova_col: str = "nova_group",
                  text_col: str = "ingredients_text") -> DataFrame:
    """Q8: expected-quality gates as (gate, actual, threshold, passed).

    Ingredients complete = non-NULL, non-blank text; nutrients complete = all
    listed nutrients present; NOVA complete = a parsable NOVA group; no
    negative and no > 100 g values in any listed nutrient."""
    nutrient_cols = [c for c in nutrient_cols if c in df.columns]
    n = F.count(F.lit(1))
    t = F.col(text_col)
    all_present = F.lit(True)
    any_neg = F.lit(False)
    any_over = F.lit(False)
    for c in nutrient_cols:
        all_present = all_present & ~_is_missing(df, c)
        any_neg = any_neg | F.coalesce(F.col(c) < 0, F.lit(False))
        any_over = any_over | F.coalesce(F.col(c) > 100, F.lit(False))
    nova_ok = F.col(nova_col).cast("string").try_cast("int").isNotNull()
    wide = df.agg(
        (F.sum(F.when(t.isNotNull() & (F.regexp_replace(t, fixed.UNICODE_TRIM_PATTERN, "") != ""), 1).otherwise(0))
         * 100.0 / n).alias("ingredients_complete_pct"),
        (F.sum(F.when(all_present, 1).otherwise(0)) * 100.0 / n).alias("nutrients_complete_pct"),
        (F.sum(F.when(nova_ok, 1).otherwise(0)) * 100.0 / n).alias("nova_complete_pct"),
        F.sum(F.when(any_neg, 1).otherwise(0)).cast("double").alias("negative_rows"),
        F.sum(F.when(any_over, 1).otherwise(0)).cast("double").alias("over_100_rows"),
    )
    gates = [(g, thr, ">") for g, thr in fixed.QUALITY_GATES] + [("negative_rows", 0.0, "="), ("over_100_rows", 0.0, "=")]
    args = ", ".join(f"'{g}', `{g}`, cast({thr} as double), '{op}'" for g, thr, op in gates)
    long = wide.selectExpr(f"stack({len(gates)}, {args}) as (gate, actual, threshold, op)")
    return long.select("gate", "actual", "threshold",
                       F.when(F.col("op") == ">", F.col("actual") > F.col("threshold"))
                       .otherwise(F.col("actual") == F.col("threshold")).alias("passed"))


def volume_gates(df: DataFrame, category_col: str,
                 total_range: tuple[int, int] = fixed.VOLUME_TOTAL_RANGE,
                 category_range: tuple[int, int] = fixed.VOLUME_CATEGORY_RANGE) -> DataFrame:
    """Q9: total and per-category row counts against the expected ranges, from
    one rollup aggregate (the total is its grand-total row)."""
    r = df.rollup(category_col).agg(F.count(F.lit(1)).cast("long").alias("n"),
                                    F.grouping(category_col).alias("_g"))
    lo = F.when(F.col("_g") == 1, F.lit(total_range[0])).otherwise(F.lit(category_range[0]))
    hi = F.when(F.col("_g") == 1, F.lit(total_range[1])).otherwise(F.lit(category_range[1]))
    return r.select(F.when(F.col("_g") == 1, F.lit("total")).otherwise(F.lit("category")).alias("scope"),
                    F.col(category_col).alias("subject"), "n", lo.cast("long").alias("low"), hi.cast("long").alias("high"),
                    ((F.col("n") >= lo) & (F.col("n") <= hi)).alias("passed"))


def overview(df: DataFrame, key: str, category_col: str, ts_col: str | None = None) -> DataFrame:
    """Q1/A10: rows, distinct keys, distinct categories and the optional
    timestamp range in one pass."""
    aggs = [F.count(F.lit(1)).cast("long").alias("n_rows"),
            F.count_distinct(key).cast("long").alias("n_distinct_keys"),
            F.count_distinct(category_col).cast("long").alias("n_categories")]
    if ts_col and ts_col in df.columns:
        aggs += [F.min(ts_col).alias("min_ts"), F.max(ts_col).alias("max_ts")]
    return df.agg(*aggs)
