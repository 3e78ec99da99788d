"""Recommender evaluation.

Scenarios, relevance lists and recommendations are tables; each metric is an
aggregate over ``recs JOIN relevance`` per (scenario, k).  The number of
scenarios is a parameter (default 100), so every per-scenario table is
bounded by it and may be broadcast; the catalogue-sized inputs are only
scanned, filtered and top-k'd with map-side window limits.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.functions import fixed
from larder.operators.aggregates import attach_one_row, value_counts
from larder.operators.joins import size_checked_broadcast
from larder.operators.tfidf import term_counts
from larder.session import cut_lineage


def _hash_order(seed: int, key: str):
    """Partition-independent pseudo-random order, identical in SQL engines."""
    return F.md5(F.concat(F.lit(str(seed)), F.lit("|"), F.col(key).cast("string")))


def _first_k(df: DataFrame, part: list[str], order: list, k: int) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)


def create_scenarios(products: DataFrame, n_scenarios: int = 100, seed: int = 42, key: str = "code",
                     name_col: str = "product_name", category_col: str = "category_searched",
                     nova_col: str = "nova_group", n_categories: int = 10) -> DataFrame:
    """M1 scenarios: the ``n_categories`` most common categories, ``n_scenarios
    // #categories`` products sampled from each (hash order on the key),
    each resolved by name to the first product with that name (J4)."""
    top = value_counts(products, category_col, n_categories)
    top = top.withColumn("cat_rank", F.row_number().over(Window.orderBy(F.desc("n"), F.asc(category_col)))) \
        .withColumn("per_cat", F.floor(F.lit(n_scenarios) / F.count(F.lit(1)).over(Window.partitionBy())))
    # ``top`` has at most n_categories rows: a proven-size broadcast.
    sampled = products.join(F.broadcast(top.select(category_col, "cat_rank", "per_cat")), category_col)
    sampled = sampled.withColumn("h", _hash_order(seed, key))
    sampled = _first_k(sampled, [category_col], [F.col("h")], n_scenarios) \
        .where(F.col("_r") <= F.col("per_cat"))
    sampled = sampled.withColumn("scenario_id", F.row_number().over(Window.orderBy("cat_rank", "_r"))) \
        .where(F.col("scenario_id") <= n_scenarios)
    # First product carrying each sampled name (by key); NULL names resolve to the sampled row.
    names = sampled.select(name_col).where(F.col(name_col).isNotNull()).distinct()
    first = (products.join(F.broadcast(names), name_col)
             .groupBy(name_col).agg(F.min_by(F.struct(key, category_col, nova_col), F.col(key)).alias("f")))
    s = sampled.select("scenario_id", F.col(key).alias("sampled_key"), name_col,
                       F.col(category_col).alias("s_cat"), F.col(nova_col).alias("s_nova"))
    s = s.join(F.broadcast(first), name_col, "left")
    return s.select(
        F.col("scenario_id").cast("long").alias("scenario_id"),
        F.coalesce(F.col("f").getField(key), F.col("sampled_key")).alias(key),
        F.col(name_col).alias("test_product"),
        F.when(F.col("f").isNotNull(), F.col("f").getField(category_col)).otherwise(F.col("s_cat"))
        .alias("test_category"),
        F.when(F.col("f").isNotNull(), F.col("f").getField(nova_col)).otherwise(F.col("s_nova")).alias("test_nova"),
    )


def relevance(products: DataFrame, scenarios: DataFrame, key: str = "code", name_col: str = "product_name",
              category_col: str = "category_searched", nova_col: str = "nova_group") -> DataFrame:
    """M1 graded relevance (scenario_id, item, rel): the first 10 same-category
    products with another name get 3; the first 15 products of the same NOVA
    group whose name does not occur in the scenario's category get 2 (W8, J6).
    Product order is the key; NULL-named products are not relevance items."""
    sc = F.broadcast(scenarios.select("scenario_id", "test_product", "test_category", "test_nova"))
    # A product meets no scenario before it is among the first of its kind.
    # Scenarios leave out their own names, so each of those (``_own_name``, null
    # for all other products) is a kind by itself: a kind is taken or left whole.
    own_names = F.broadcast(scenarios.select(F.col("test_product").alias(name_col)).where(F.col(name_col).isNotNull()).distinct()
                            .withColumn("_own_name", F.col(name_col)))
    named = (products.where(F.col(name_col).isNotNull()).select(key, name_col, category_col, nova_col)
             .join(own_names, name_col, "left"))
    cats = F.broadcast(scenarios.select(F.col("test_category").alias(category_col)).distinct())
    same = _first_k(named.join(cats, category_col, "left_semi"), [category_col, "_own_name"], [F.col(key)],
                    fixed.SAME_CATEGORY_LIMIT).drop("_r")
    same = (same.join(sc, F.col(category_col) == F.col("test_category"))
            .where(~(F.col("test_product").isNotNull() & (F.col(name_col) == F.col("test_product")))))
    same = _first_k(same, ["scenario_id"], [F.col(key)], fixed.SAME_CATEGORY_LIMIT) \
        .select("scenario_id", F.col(name_col).alias("item")).distinct() \
        .withColumn("rel", F.lit(fixed.RELEVANCE_SAME_CATEGORY))
    # The names that occur in a scenario's category are left out (J6).  The
    # categories of each name, out of those few that scenarios have, are
    # collected once; a kind here has one NOVA group and one set of categories.
    held = (named.join(cats, category_col, "left_semi").groupBy(name_col)
            .agg(F.sort_array(F.collect_set(category_col)).alias("_held")))
    combos = F.broadcast(sc.select("test_category", "test_nova", F.when(F.col("test_category").isNull(), F.col("test_product"))
                                   .alias("_own")).distinct())
    novas = F.broadcast(scenarios.select(F.col("test_nova").alias(nova_col)).distinct())
    sim = named.join(novas, nova_col, "left_semi").join(size_checked_broadcast(held), name_col, "left")
    sim = _first_k(sim, [nova_col, "_held", "_own_name"], [F.col(key)], fixed.SIMILAR_NOVA_LIMIT).drop("_r")
    sim = sim.join(combos, F.col(nova_col) == F.col("test_nova"))
    outside = ~F.coalesce(F.array_contains("_held", F.col("test_category")), F.lit(False))
    sim = sim.where(outside & ~F.coalesce(F.col(name_col) == F.col("_own"), F.lit(False)))
    # A scenario's own name occurs in its category (or is the combination's ``_own``), so it is out already.
    sim = _first_k(sim, ["test_category", "test_nova", "_own"], [F.col(key)], fixed.SIMILAR_NOVA_LIMIT)
    sim = sim.select("test_category", "test_nova", "_own", F.col(name_col).alias("item")).distinct()
    s = sc.select("scenario_id", F.col("test_category").alias("_c"), F.col("test_nova").alias("_v"),
                  F.when(F.col("test_category").isNull(), F.col("test_product")).alias("_p"))
    sim = (sim.join(s, F.col("test_category").eqNullSafe(F.col("_c")) & (F.col("test_nova") == F.col("_v"))
                    & F.col("_own").eqNullSafe(F.col("_p")))
           .select("scenario_id", "item").withColumn("rel", F.lit(fixed.RELEVANCE_SIMILAR_NOVA)))
    return same.unionByName(sim)


def metrics_per_scenario(recs: DataFrame, rel: DataFrame, scenarios: DataFrame, item_category: DataFrame,
                         k_values: Sequence[int] = (5, 10, 20)) -> DataFrame:
    """M2-M5 per (scenario_id, k).

    ``recs(scenario_id, rank, item)`` ranks from 1; ``item_category(item,
    category)`` gives the category of the first product with each name.
    A scenario without recommendations scores precision/recall/NDCG 0 and
    diversity 1.0; recall and NDCG are 0 without relevant items."""
    # Only the recommended items are looked up, not every name of the catalogue.
    item_category = item_category.join(F.broadcast(recs.select("item").distinct()), "item", "left_semi")
    ks = F.broadcast(scenarios.select("scenario_id", F.explode(F.array(*[F.lit(int(k)) for k in k_values])).alias("k")))
    topk = recs.join(ks, "scenario_id").where(F.col("rank") <= F.col("k"))
    topk = topk.join(rel, ["scenario_id", "item"], "left").join(item_category, "item", "left")
    per = topk.groupBy("scenario_id", "k").agg(
        F.count(F.lit(1)).alias("n_recs"),
        F.sum(F.when(F.col("rel").isNotNull(), 1).otherwise(0)).alias("hits"),
        F.count_distinct(F.when(F.col("rel").isNotNull(), F.col("item"))).alias("distinct_hits"),
        F.sum(F.coalesce(F.col("rel"), F.lit(0)) / F.log2(F.col("rank") + 1)).alias("dcg"),
        F.count_distinct("category").alias("n_cats"),
    )
    n_rel = rel.groupBy("scenario_id").agg(F.count(F.lit(1)).alias("n_rel"))
    ideal = rel.join(ks, "scenario_id")
    ideal = ideal.withColumn("ir", F.row_number().over(Window.partitionBy("scenario_id", "k")
                                                        .orderBy(F.desc("rel"), F.asc("item"))))
    idcg = ideal.where(F.col("ir") <= F.col("k")).groupBy("scenario_id", "k").agg(
        F.sum(F.col("rel") / F.log2(F.col("ir") + 1)).alias("idcg"))
    out = ks.join(per, ["scenario_id", "k"], "left").join(n_rel, "scenario_id", "left") \
        .join(idcg, ["scenario_id", "k"], "left")
    has_recs = F.coalesce(F.col("n_recs"), F.lit(0)) > 0
    has_rel = F.coalesce(F.col("n_rel"), F.lit(0)) > 0
    return out.select(
        "scenario_id", "k",
        F.when(has_recs, F.col("hits") / F.col("k")).otherwise(F.lit(0.0)).alias("precision"),
        F.when(has_recs & has_rel, F.col("distinct_hits") / F.col("n_rel")).otherwise(F.lit(0.0)).alias("recall"),
        F.when(has_recs & has_rel & (F.coalesce(F.col("idcg"), F.lit(0.0)) > 0), F.col("dcg") / F.col("idcg"))
        .otherwise(F.lit(0.0)).alias("ndcg"),
        F.when(F.coalesce(F.col("n_recs"), F.lit(0)) < 2, F.lit(1.0))
        .otherwise(F.col("n_cats") / F.col("n_recs")).alias("diversity"),
    )


def summarise(metrics: DataFrame) -> DataFrame:
    """Mean, population std, median, min, max per (metric, k)."""
    long = metrics.selectExpr(
        "k", "stack(4, 'precision', precision, 'recall', recall, 'ndcg', ndcg, 'diversity', diversity)"
             " as (metric, value)")
    return long.groupBy("metric", "k").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.median("value").alias("median"),
        F.min("value").alias("min"), F.max("value").alias("max"))


def coverage(recs: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct recommended items over the catalogue size."""
    items = recs.agg(F.count_distinct("item").alias("n_items"))
    total = products.agg(F.count(F.lit(1)).alias("total"))
    return attach_one_row(items, total).select(
        F.try_divide(F.col("n_items"), F.col("total")).alias("catalog_coverage"))


def pair_similarity(weights: DataFrame, pairs: DataFrame, key: str) -> DataFrame:
    """Cosine of the listed (ka, kb) pairs only, from L2-normalised sparse
    rows: each pair joins the terms of its first item, then the matching
    terms of its second.  Cost is bounded by pairs x terms per item; pairs
    sharing no term are absent (similarity 0)."""
    p = size_checked_broadcast(pairs.select("ka", "kb").distinct())
    # The rows of the listed items, stored, so that the planner knows their size
    # and never takes the whole matrix for a table to broadcast.
    listed = size_checked_broadcast(p.select(F.explode(F.array("ka", "kb")).alias(key)).distinct())
    weights = cut_lineage(weights.join(listed, key, "left_semi"))
    a = weights.select(F.col(key).alias("ka"), "term", F.col("weight").alias("wa"))
    b = weights.select(F.col(key).alias("kb"), "term", F.col("weight").alias("wb"))
    return (p.join(a, "ka").join(b, ["kb", "term"])
            .groupBy("ka", "kb").agg(F.sum(F.col("wa") * F.col("wb")).alias("sim")))


def similarity_diversity(recs: DataFrame, item_key: DataFrame, weights: DataFrame, key: str,
                         threshold: float = fixed.DISSIMILAR_THRESHOLD) -> DataFrame:
    """M6 per scenario: share of item pairs (earlier, later position) whose
    similarity is below ``threshold``; items are looked up by name
    (``item_key(item, key)``), pairs with an unknown item are skipped,
    pairs without shared terms have similarity 0; no pairs -> 0.0."""
    items = F.broadcast(recs.select("item").distinct())  # at most the recommendations
    r = cut_lineage(recs.join(item_key.join(items, "item", "left_semi"), "item"))
    a = r.select("scenario_id", F.col("rank").alias("ra"), F.col(key).alias("ka"))
    b = r.select("scenario_id", F.col("rank").alias("rb"), F.col(key).alias("kb"))
    pairs = a.join(b, "scenario_id").where(F.col("ra") < F.col("rb"))
    sims = pair_similarity(weights, pairs, key)
    j = pairs.join(sims, ["ka", "kb"], "left")
    per = j.groupBy("scenario_id").agg(
        F.sum(F.when(F.coalesce(F.col("sim"), F.lit(0.0)) < threshold, 1).otherwise(0)).alias("d"),
        F.count(F.lit(1)).alias("t"))
    return per.select("scenario_id", F.when(F.col("t") > 0, F.col("d") / F.col("t")).otherwise(0.0)
                      .alias("similarity_diversity"))


def evaluate(products: DataFrame, recommender: Callable[[DataFrame], DataFrame], n_scenarios: int = 100,
             seed: int = 42, k_values: Sequence[int] = (5, 10, 20), key: str = "code",
             name_col: str = "product_name", category_col: str = "category_searched",
             nova_col: str = "nova_group") -> dict[str, DataFrame]:
    """M8/M9: run a pluggable recommender ``scenarios -> recs(scenario_id,
    rank, item)`` and return the scenario, relevance, per-scenario metric,
    summary and coverage tables."""
    # Scenario, relevance and recommendation tables are small (bounded by
    # n_scenarios) and each feeds several metrics: materialise them once.
    sc = cut_lineage(create_scenarios(products, n_scenarios, seed, key, name_col, category_col, nova_col))
    rel = cut_lineage(relevance(products, sc, key, name_col, category_col, nova_col))
    recs = cut_lineage(recommender(sc))
    item_cat = (products.where(F.col(name_col).isNotNull())
                .groupBy(name_col).agg(F.min_by(category_col, F.col(key)).alias("category"))
                .withColumnRenamed(name_col, "item"))
    per = metrics_per_scenario(recs, rel, sc, item_cat, k_values)
    return {"scenarios": sc, "relevance": rel, "recs": recs, "metrics": per,
            "summary": summarise(per), "coverage": coverage(recs, products)}


MAX_FEATURES, NGRAM_RANGES, MIN_DF, MAX_DF = (50, 100, 200, 500), ((1, 1), (1, 2), (1, 3)), (1, 2, 3), (0.8, 0.9, 0.95)


#: Products of a task of the grid, and those it weighs at once.
_GRID_PER_TASK, _GRID_STEP = 25_000, 1_000


def _grid_nearest(tf: DataFrame, key: str, n: int, vocabulary: list, sides: list[tuple[int, float]], max_features: Sequence[int],
                  targets: DataFrame, top_n: int) -> DataFrame:
    """(config, a, b, sim): in every task, per configuration and target a, the
    ``top_n`` most similar of the task's products b (ties by key) that share a
    term with it; the target's norm, which orders nothing, is left out.

    The vocabularies of a side (min_df, max_df) are first terms of one ranking,
    so a task weighs a product's terms once per side and takes the sums of its
    configurations from the leading columns."""
    spark = tf.sparkSession
    numbers = {t: i for i, t in enumerate(sorted({v["term"] for v in vocabulary}))}
    ranked = [sorted((v for v in vocabulary if (v["lo"], v["hi"]) == side), key=lambda v: v["_r"]) for side in sides]
    columns = [np.array([numbers[v["term"]] for v in side], dtype=int) for side in ranked]
    idf = [np.array([math.log((1.0 + n) / (1.0 + v["df"])) + 1.0 for v in side]) for side in ranked]
    ids = F.broadcast(spark.createDataFrame(list(numbers.items()), "term string, t int"))
    pairs = F.sort_array(F.collect_list(F.struct("t", F.col("tf").cast("double").alias("tf")))).alias("p")

    def packed(counts):
        return counts.groupBy(F.col(key).alias("b")).agg(pairs).select("b", F.col("p.t").alias("t"), F.col("p.tf").alias("tf"))

    known = tf.where(F.col(key).isNotNull()).join(ids, "term")
    asked = packed(known.join(targets, key, "left_semi")).orderBy("b").collect()  # the targets
    wide = np.zeros((len(numbers), len(asked)))
    for i, row in enumerate(asked):
        wide[row["t"], i] = row["tf"]
    weights = [wide[c] * f[:, None] for c, f in zip(columns, idf, strict=True)]
    width, many = len(numbers), len(asked)

    def nearest(batches):
        held, kind = {}, None  # (config, target): similarities, keys; best first
        for batch in batches:
            kind = batch.schema.field("b").type
            for lo in range(0, batch.num_rows, _GRID_STEP):
                part = batch.slice(lo, _GRID_STEP)
                terms, own = part.column("t"), np.asarray(part.column("own"))
                x = np.zeros((part.num_rows, width))
                at = np.repeat(np.arange(part.num_rows), np.asarray(terms.value_lengths()))
                x[at, np.asarray(terms.flatten())] = np.asarray(part.column("tf").flatten())
                for s, (cols, factor) in enumerate(zip(columns, idf, strict=True)):
                    w = x[:, cols] * factor
                    square = np.cumsum(w * w, axis=1)
                    for j, most in enumerate(max_features):
                        upto = min(most, len(cols))
                        if not upto:
                            continue
                        dots = w[:, :upto] @ weights[s][:upto]
                        sim = np.where(dots > 0, dots / np.sqrt(np.maximum(square[:, upto - 1], 1e-300))[:, None], -1.0)
                        mine = np.flatnonzero(own >= 0)
                        sim[mine, own[mine]] = -1.0
                        # Rows come in key order: a later one must be better than the last one held.
                        config = s * len(max_features) + j
                        full = [held.get((config, a)) for a in range(many)]
                        least = np.array([np.round(h[0][-1], 9) if h and len(h[0]) == top_n else -1.0 for h in full])
                        better = np.round(sim, 9) > least
                        for a in np.flatnonzero(better.any(axis=0)):
                            rows = np.flatnonzero(better[:, a])
                            rows = rows[np.argsort(-np.round(sim[rows, a], 9), kind="stable")[:top_n]]
                            was = full[a] or (np.empty(0), [])
                            value = np.concatenate([was[0], sim[rows, a]])
                            keys = was[1] + part.column("b").take(pa.array(rows)).to_pylist()
                            order = np.argsort(-np.round(value, 9), kind="stable")[:top_n]
                            held[config, a] = value[order], [keys[o] for o in order]
        out = [(c, a, k, v) for (c, a), (values, keys) in held.items() for v, k in zip(values, keys, strict=True)]
        if out:
            c, a, k, v = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(a, pa.int32()), pa.array(k, kind), pa.array(v, pa.float64())],
                                             names=["config", "i", "b", "sim"])

    kind = tf.schema[key].dataType.simpleString()
    order = spark.createDataFrame([(i, row["b"]) for i, row in enumerate(asked)], f"own int, a {kind}")
    dealt = packed(known.repartition(max(1, math.ceil(n / _GRID_PER_TASK)), key))
    dealt = (dealt.join(F.broadcast(order.withColumnRenamed("a", "b")), "b", "left").select("b", "t", "tf", F.coalesce("own", F.lit(-1)).alias("own"))
             .sortWithinPartitions("b"))
    found = dealt.mapInArrow(nearest, f"config int, i int, b {kind}, sim double")
    return found.join(F.broadcast(order.withColumnRenamed("own", "i")), "i").select("config", "a", "b", "sim")


def tfidf_grid_search(products: DataFrame, scenarios: DataFrame, rel: DataFrame, max_features: Sequence[int] = MAX_FEATURES,
                      ngram_ranges: Sequence[tuple[int, int]] = NGRAM_RANGES, min_dfs: Sequence[int] = MIN_DF,
                      max_dfs: Sequence[float] = MAX_DF, n_eval: int = 20, k: int = 10, top_n: int = 20, key: str = "code",
                      name_col: str = "product_name", text_col: str = "ingredients_text",
                      category_col: str = "category_searched") -> DataFrame:
    """V7/T5: for every TF-IDF configuration, recommend the ``top_n`` products
    most similar (cosine) to each of the first ``n_eval`` scenarios and score
    mean NDCG@k (also precision, recall, diversity); one row per configuration.

    Terms are counted once per n-gram range.  A configuration only chooses
    among them, so the vocabularies of all configurations of a range are one
    small table, and the products pass once per range (``_grid_nearest``)."""
    text = F.lower(F.coalesce(F.nullif(F.col(text_col), F.lit("")), F.lit("unknown")))
    docs = cut_lineage(products.select(key, text.alias("text")))
    n = docs.count()
    sc = scenarios.where(F.col("scenario_id") <= n_eval)
    targets = F.broadcast(sc.select(key).distinct())  # at most n_eval rows
    names = products.select(F.col(key).alias("b"), F.col(name_col).alias("item"))
    item_cat = (products.where(F.col(name_col).isNotNull())
                .groupBy(name_col).agg(F.min_by(category_col, F.col(key)).alias("category"))
                .withColumnRenamed(name_col, "item"))
    cells = [(lo, hi, mf) for lo in min_dfs for hi in max_dfs for mf in max_features]
    out = None
    for r, ngrams in enumerate(ngram_ranges):
        tf = cut_lineage(term_counts(docs, key, "text", ngrams))
        stats = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ctf"))
        sides = F.explode(F.array(*[F.struct(F.lit(lo).alias("lo"), F.lit(float(hi)).alias("hi")) for lo in min_dfs for hi in max_dfs]))
        each = stats.withColumn("s", sides).where((F.col("df") >= F.col("s.lo")) & (F.col("df") <= F.col("s.hi") * n))
        order = Window.partitionBy("s.lo", "s.hi").orderBy(F.desc("ctf"), F.asc("term"))
        each = each.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= max(max_features))
        vocabulary = each.select("s.lo", "s.hi", "_r", "term", "df").collect()  # bounded: at most max_features terms per side
        sims = _grid_nearest(tf, key, n, vocabulary, [(lo, float(hi)) for lo in min_dfs for hi in max_dfs], max_features, targets, top_n)
        sims = sims.withColumn("config", F.col("config") + r * len(cells))
        best = Window.partitionBy("config", "a").orderBy(F.desc(F.round("sim", 9)), F.asc("b"))
        sims = sims.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top_n)
        # Each scenario counts once per configuration, under a number of its own.
        own = F.col("config") * (n_eval + 1) + F.col("scenario_id")
        configs = F.explode(F.array(*[F.lit(r * len(cells) + i) for i in range(len(cells))])).alias("config")
        recs = cut_lineage(sc.select("scenario_id", F.col(key).alias("a")).join(sims, "a").join(names, "b")
                           .select(own.alias("scenario_id"), F.col("rank").cast("long").alias("rank"), "item"))
        scen = sc.select("scenario_id", configs).select(own.alias("scenario_id"))
        rels = rel.join(sc.select("scenario_id"), "scenario_id").select("*", configs).select(own.alias("scenario_id"), "item", "rel")
        per = metrics_per_scenario(recs, rels, scen, item_cat, [k])
        row = per.groupBy(F.floor(F.col("scenario_id") / (n_eval + 1)).cast("int").alias("config")).agg(
            F.avg("ndcg").alias("score"), F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
            F.avg("diversity").alias("diversity"))
        labels = [f"max_features={mf}, ngram_range={tuple(ngrams)}, min_df={lo}, max_df={hi}" for lo, hi, mf in cells]
        row = row.withColumn("params", F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("config") - r * len(cells) + 1))
        out = row if out is None else out.unionByName(row)
    return out


def best_configuration(results: DataFrame) -> DataFrame:
    """T5: the configuration with the highest score (ties: lowest index)."""
    return results.agg(F.max_by(F.struct("config", "params", "score"),
                                F.struct(F.col("score"), -F.col("config"))).alias("best")).select("best.*")
