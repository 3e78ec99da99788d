"""Healthier-alternative recommender for the whole catalogue in one job
(J1-J3, W1, F14-F16, M10, M11).

The per-product theta join (same scope, other name, lower score, best N) is
never built pair-wise.  The candidate order (score, code) does not depend on
the product asking, and a product only removes candidates sharing its own
name (or code), so:

1. per (scope, name) keep the best N rows; per scope keep the best 2N of
   those.  Any product's best N candidates lie in that shortlist (a name
   contributes at most N rows).  Both are ``row_number() <= k`` filters that
   Spark plans with a map-side ``WindowGroupLimit``, so even a scope holding a
   third of all rows ships at most k rows per map task to the reducer.
2. the shortlist of each scope (<= 2N structs) is folded into one array row
   per scope; that small table is broadcast after its row count is checked
   (``joins.size_checked_broadcast``), beyond the bound it is a shuffle join
   that AQE can split for skew.
3. every product then picks its own N from the array with higher-order
   functions — a narrow, map-side step over the big table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions import fixed
from larder.functions import scoring as S
from larder.functions import text as X
from larder.operators.joins import BROADCAST_BYTES, size_checked_broadcast

GLOBAL_SCOPE = "\u0000all"


def _top_k(df: DataFrame, part: list, order: list, k: int) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= k).drop("_rk")


def scope_shortlists(cands: DataFrame, scope: str, exclude_key: str, order: list[str], n: int,
                     payload: list[str]) -> DataFrame:
    """(scope, shortlist array<struct(order..., payload...)>) with <= 2n
    entries per scope, exact for any product excluding one ``exclude_key``
    value."""
    per_key = _top_k(cands, [scope, exclude_key], [F.col(c) for c in order], n)
    per_scope = _top_k(per_key, [scope], [F.col(c) for c in order], 2 * n)
    fields = list(dict.fromkeys(order + payload))
    return per_scope.groupBy(scope).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("shortlist"))


def healthier_alternatives(scored: DataFrame, top_n: int = 3, same_category_only: bool = True,
                           key: str = "code", name_col: str = "product_name",
                           category_col: str = "category_searched", score_col: str = "processing_score",
                           broadcast_max_bytes: int = BROADCAST_BYTES, targets: DataFrame | None = None) -> DataFrame:
    """J1 + J2 + W1 (+ J3 when ``same_category_only`` is False) for every
    product: rows (code, rank, alt_*) with the best ``top_n`` candidates of
    strictly lower score, or of equal-or-lower score when none is strictly
    lower; candidates with the product's own (non-NULL) name are excluded, a
    NULL name excludes nothing; ties by candidate code.  ``targets`` (a
    DataFrame of keys) restricts the products answered for."""
    cat = F.col(category_col)
    if same_category_only:
        scope = F.when(cat.isNull() | (cat == ""), F.lit(GLOBAL_SCOPE)).otherwise(cat)
    else:
        scope = F.lit(GLOBAL_SCOPE)
    base = scored.select(
        F.col(key).alias("k"), F.col(name_col).alias("name"), cat.alias("category"),
        F.col(score_col).alias("score"), scope.alias("scope"),
        *[F.col(c) for c in ("nova_group", "e_numbers", "concerning_additives", "sugar_100g", "salt_100g", "brand")
          if c in scored.columns])
    payload = [c for c in ("name", "category", "nova_group", "e_numbers", "sugar_100g", "salt_100g", "brand")
               if c in base.columns]
    order = [F.col("score"), F.col("k")]
    # Name exclusion key: NULL names form one group, like any other name.
    keyed = base.withColumn("xkey", F.coalesce(F.col("name"), F.lit("\u0000null")))
    # Best N per (category, name): a superset of the best N per name overall.
    per_key = _top_k(keyed, ["category", "xkey"], order, top_n)
    scoped = []
    if same_category_only:
        scoped.append(_top_k(per_key, ["category"], order, 2 * top_n)
                      .where(F.col("category").isNotNull() & (F.col("category") != ""))
                      .withColumn("scope", F.col("category")))
    # Global shortlist (cross-category mode, and products without a category):
    # per-name best N across categories, then the overall best 2N — an ordered
    # limit, planned as a per-task top-k and a small merge.
    glob = _top_k(per_key, ["xkey"], order, top_n).orderBy(*order).limit(2 * top_n)
    scoped.append(glob.withColumn("scope", F.lit(GLOBAL_SCOPE)))
    short_rows = scoped[0] if len(scoped) == 1 else scoped[0].unionByName(scoped[1])
    fields = ["score", "k"] + payload
    shortlist = short_rows.groupBy("scope").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("shortlist"))
    prod = base.select("k", "name", "score", "scope")
    if targets is not None:
        prod = prod.join(targets.select(F.col(key).alias("k")).distinct(), "k", "left_semi")
    if same_category_only:
        joined = prod.join(size_checked_broadcast(shortlist, broadcast_max_bytes), "scope", "left")
    else:
        # One global shortlist (<= 2N entries): a scalar subquery, no join.
        from larder.operators.aggregates import attach_one_row
        joined = attach_one_row(prod, shortlist.select("shortlist"))
    eligible = F.filter(F.coalesce(F.col("shortlist"), F.array()),
                        lambda c: (c["score"] <= F.col("score"))
                        & ~(F.col("name").isNotNull() & c["name"].isNotNull() & (c["name"] == F.col("name"))))
    strict = F.filter(eligible, lambda c: c["score"] < F.col("score"))
    chosen = F.slice(F.when(F.size(strict) > 0, strict).otherwise(eligible), 1, top_n)
    out = joined.select("k", F.col("score").alias("input_score"), F.posexplode(chosen).alias("pos", "alt"))
    cols = [F.col("k").alias("code"), (F.col("pos") + 1).cast("long").alias("rank"),
            F.col("alt.k").alias("alt_code"), F.col("alt.name").alias("alt_name"),
            F.col("alt.category").alias("alt_category"), F.col("alt.score").alias("alt_score"),
            (F.col("input_score") - F.col("alt.score")).alias("score_improvement"),
            S.processing_badge(F.col("alt.score")).alias("alt_badge"),
            S.processing_label(F.col("alt.score")).alias("alt_label")]
    if "nova_group" in payload:
        cols.append(S.nova_label(F.col("alt.nova_group")).alias("alt_nova_label"))
    for c in ("e_numbers", "sugar_100g", "salt_100g", "brand"):
        if c in payload:
            cols.append(F.col(f"alt.{c}").alias(f"alt_{c}"))
    return out.select(*cols)


# --- healthiness-model recommender (M11) and its evaluation (M10) ------------------------

def _substring_keys(s: Column, max_len: int = 3) -> Column:
    """All substrings of length 1..max_len of ``s`` (an exact pre-filter for
    ``contains``: any root of length L contains its own prefix of length
    min(L, max_len), which must then occur in the category text)."""
    n = F.length(s)
    return F.flatten(F.transform(F.sequence(F.lit(1), F.lit(max_len)), lambda L: F.transform(
        F.sequence(F.lit(1), F.greatest(n - L + 1, F.lit(1))), lambda i: F.substring(s, i, L))))


def root_category_map(roots: DataFrame, categories: DataFrame) -> DataFrame:
    """(root, categories_lc) where the lower-cased category text contains the
    lower-cased root.  An equi-join on a short substring key replaces the
    theta join; ``contains`` then verifies each candidate pair.  The empty
    root matches every category (``str.contains('')``)."""
    r = roots.select(F.lower(F.col("root")).alias("root_lc"), "root").distinct()
    c = categories.select(F.lower(F.col("categories_en")).alias("categories_lc")).distinct()
    keyed_c = c.select("categories_lc", F.explode(F.array_distinct(_substring_keys(F.col("categories_lc")))).alias("sk"))
    keyed_r = r.where(F.length("root_lc") > 0).withColumn("sk", F.substring("root_lc", 1, 3))
    hit = (keyed_r.join(keyed_c, "sk")
           .where(F.col("categories_lc").contains(F.col("root_lc")))
           .select("root", "categories_lc"))
    # The empty root (if any product has one) matches every category.
    empty_root = r.where(F.length("root_lc") == 0).agg(F.first("root").alias("root"))
    from larder.operators.aggregates import attach_one_row
    empty = attach_one_row(c, empty_root).where(F.col("root").isNotNull()).select("root", "categories_lc")
    return hit.unionByName(empty).distinct()


def _picked_alternatives(features: DataFrame, top_n: int, key: str, broadcast_max_bytes: int) -> DataFrame:
    """Every product (t, t_score, t_cnt, t_nova, t_e) with the array of its
    best candidates: their category text contains the product's root category
    (case-insensitive), they are sold in Ireland, have another code and a
    strictly lower healthiness score; ordered by improvement, then code.

    ``features`` needs: code, product_name, categories_en, countries_sold,
    ingredient_count, nova_int, e_numbers, n_additives, healthiness_score."""
    f = features.withColumn("root", X.category_root(F.col("categories_en")))
    elig = f.where(F.coalesce(F.lower(F.col("countries_sold")).contains("ireland"), F.lit(False))) \
        .where(F.col("categories_en").isNotNull())
    rmap = root_category_map(f.select("root"), elig.select("categories_en"))
    cands = (elig.drop("root").withColumn("categories_lc", F.lower("categories_en"))
             .join(rmap, "categories_lc")
             .select("root", F.col(key).alias("k"), F.col("healthiness_score").alias("score"),
                     F.col("product_name").alias("name"), "ingredient_count", "nova_int", "e_numbers"))
    shortlist = scope_shortlists(cands, "root", "k", ["score", "k"], top_n,
                                 ["name", "ingredient_count", "nova_int", "e_numbers"])
    shortlist = size_checked_broadcast(shortlist, broadcast_max_bytes)
    tgt = f.select(F.col(key).alias("t"), "root", F.col("healthiness_score").alias("t_score"),
                   F.col("ingredient_count").alias("t_cnt"), F.col("nova_int").alias("t_nova"),
                   F.col("e_numbers").alias("t_e"))
    j = tgt.join(shortlist, "root", "left")
    picked = F.slice(F.filter(F.coalesce(F.col("shortlist"), F.array()),
                              lambda c: (c["k"] != F.col("t")) & (c["score"] < F.col("t_score"))), 1, top_n)
    return j.select("t", "t_score", "t_cnt", "t_nova", "t_e", picked.alias("picked"))


def better_alternatives(features: DataFrame, top_n: int = 10, key: str = "code",
                        broadcast_max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """M11 for every product (see ``_picked_alternatives``): rank, improvement,
    percentage (one decimal, F18) and the explanation text."""
    picked = _picked_alternatives(features, top_n, key, broadcast_max_bytes)
    out = picked.select("t", "t_score", "t_cnt", "t_nova", "t_e", F.posexplode("picked").alias("pos", "a"))
    d = lambda c: F.coalesce(c, F.lit(fixed.HEALTH_DEFAULT_INGREDIENTS))
    return out.select(
        F.col("t").alias("code"), (F.col("pos") + 1).cast("long").alias("rank"),
        F.col("a.k").alias("alt_code"), F.col("a.name").alias("alt_name"),
        F.col("a.ingredient_count").alias("alt_ingredient_count"), F.col("a.nova_int").alias("alt_nova"),
        F.col("a.score").alias("alt_healthiness"),
        (F.col("t_score") - F.col("a.score")).alias("improvement"),
        F.round(F.try_divide((F.col("t_score") - F.col("a.score")) * 100.0, F.col("t_score")), 1).alias("improvement_pct"),
        S.explanation(d(F.col("t_cnt")), d(F.col("a.ingredient_count")),
                      F.coalesce(F.col("t_nova"), F.lit(fixed.HEALTH_DEFAULT_NOVA)),
                      F.coalesce(F.col("a.nova_int"), F.lit(fixed.HEALTH_DEFAULT_NOVA)),
                      F.col("t_e"), F.col("a.e_numbers")).alias("why_better"),
    )


def health_improvement(features: DataFrame, top_n: int = 10, key: str = "code",
                       broadcast_max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per target with alternatives, target minus the mean of its top-n
    alternatives (ingredients, NOVA, E-numbers) and the mean improvement;
    then the mean over targets.  ``n_tested`` counts every target.  The means
    are taken inside each target's array of alternatives, so nothing is
    joined or shuffled on the few products that everyone is pointed to."""
    picked = _picked_alternatives(features, top_n, key, broadcast_max_bytes)
    cnt, nova = F.lit(fixed.HEALTH_DEFAULT_INGREDIENTS), F.lit(fixed.HEALTH_DEFAULT_NOVA)

    def mean(value):
        # NULL values are left out, as in avg().
        values = F.filter(F.transform("picked", value), lambda v: v.isNotNull())
        total = F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v.cast("double"))
        return F.when(F.size("picked") > 0, F.try_divide(total, F.size(values)))

    per = picked.select(
        (F.coalesce("t_cnt", cnt) - mean(lambda a: F.coalesce(a["ingredient_count"], cnt))).alias("d_cnt"),
        (F.coalesce("t_nova", nova) - mean(lambda a: F.coalesce(a["nova_int"], nova))).alias("d_nova"),
        (F.col("t_e") - mean(lambda a: a["e_numbers"])).alias("d_e"),
        mean(lambda a: F.col("t_score") - a["score"]).alias("d_score"))
    return per.agg(F.avg("d_cnt").alias("avg_ingredient_reduction"), F.avg("d_nova").alias("avg_nova_improvement"),
                   F.avg("d_e").alias("avg_e_number_reduction"), F.avg("d_score").alias("avg_score_improvement"),
                   F.count(F.lit(1)).cast("long").alias("n_tested"))
