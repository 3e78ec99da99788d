"""Catalogue-wide scoring (F8-F13 re-aimed from one product to all products)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import scoring as S
from larder.functions import text as X


def score_catalogue(df: DataFrame, text_col: str = "ingredients_text", nova_col: str = "nova_group",
                    numeric_nova: bool = False) -> DataFrame:
    """Add E-number count, concerning additives, processing score, NOVA label
    and badge to every product — one narrow projection, no shuffle."""
    adds = S.concerning_additives(F.col(text_col))
    return (df
            .withColumn("concerning_additives", adds)
            .withColumn("e_numbers", S.e_number_count(F.col(text_col)).cast("long"))
            .withColumn("n_additives", F.size("concerning_additives").cast("long"))
            .withColumn("processing_score",
                        S.score_of_counts(F.col(nova_col), F.col("e_numbers"), F.col("n_additives"), numeric_nova).cast("long"))
            .withColumn("nova_label", S.nova_label(F.col(nova_col)))
            .withColumn("badge", S.processing_badge(F.col("processing_score")))
            .withColumn("processing_label", S.processing_label(F.col("processing_score"))))


def product_analysis(df: DataFrame) -> DataFrame:
    """F13 for every product: score, label, E-count, additives and suggestions."""
    scored = score_catalogue(df)
    return scored.select(
        "code", "product_name", "brand", "category_searched", "nova_group", "nova_label",
        "processing_score", "badge", "processing_label", "e_numbers",
        S.additive_names(F.col("concerning_additives")).alias("additives"),
        "sugar_100g", "salt_100g",
        F.array_join(S.suggestions(F.col("ingredients_text"), F.col("e_numbers"),
                                   F.col("concerning_additives")), " || ").alias("suggestions"),
    )


def health_features(df: DataFrame, text_col: str = "ingredients_text", nova_col: str = "nova_group") -> DataFrame:
    """Columns of the healthiness model (F6, F15): ingredient count, NOVA,
    E-numbers, additive count and the healthiness score."""
    out = (df
           .withColumn("ingredient_count", X.count_ingredients(F.col(text_col)).cast("long"))
           .withColumn("nova_int", S.nova_int(F.col(nova_col)).cast("long"))
           .withColumn("e_numbers", S.e_number_count(F.col(text_col)).cast("long"))
           .withColumn("n_additives", F.size(S.concerning_additives(F.col(text_col))).cast("long")))
    return out.withColumn("healthiness_score",
                          S.healthiness_score(F.col("ingredient_count"), F.col("nova_int"),
                                              F.col("e_numbers"), F.col("n_additives")))
