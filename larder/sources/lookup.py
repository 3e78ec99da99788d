"""S8 barcode lookup, re-aimed as a join of many codes to the catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def barcode_lookup(codes: DataFrame, catalogue: DataFrame, key: str = "code") -> DataFrame:
    """Left join so codes that are not found stay visible, with the display
    defaults ('Unknown' / 'NO DATA').  Join strategy is left to AQE: both
    sides are keyed by ``code`` and either may be large."""
    cat = catalogue.select(F.col(key).alias("_k"), "product_name", "brand", "nova_group", "ingredients_text")
    j = codes.join(cat, codes[key] == cat["_k"], "left")
    return j.select(
        codes[key].alias("code"),
        F.coalesce("product_name", F.lit("Unknown")).alias("product_name"),
        F.coalesce("brand", F.lit("Unknown")).alias("brand"),
        F.coalesce("nova_group", F.lit("NO DATA")).alias("nova_group"),
        F.coalesce(F.nullif(F.col("ingredients_text"), F.lit("")), F.lit("NO DATA")).alias("ingredients"),
        F.col("_k").isNotNull().alias("found"),
    )
