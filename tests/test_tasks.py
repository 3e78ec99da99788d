"""How work is dealt over tasks where tables are large for their bytes."""

import numpy as np

from larder.operators import category_pairs as P
from larder.sources.tables import PRODUCTS_PER_TASK, catalogue


def test_products_of_a_small_file_are_spread(spark, tmp_path):
    n = 3 * PRODUCTS_PER_TASK + 1
    part = spark.range(n, numPartitions=1).selectExpr("id as p_partkey", "'hot bolt' as p_name", "'Brand#1' as p_brand",
                                                      "'LARGE' as p_type", "cast(id % 50 as int) as p_size")
    part.write.parquet(f"{tmp_path}/part.parquet")
    products = catalogue(spark, str(tmp_path))
    held = products.selectExpr("spark_partition_id() as task", "code").groupBy("task").agg({"code": "count"}).collect()
    assert len(held) >= 4 and sum(r[1] for r in held) == n and max(r[1] for r in held) < 2 * PRODUCTS_PER_TASK
    assert products.select("code").distinct().count() == n


def test_pairs_are_drawn_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(P, "PAIRS_PER_TASK", 100)
    monkeypatch.setattr(P, "CHUNK", 20)
    df = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(120)], "code int, category_searched string")
    pairs = P.category_pairs(df)
    # A count that is told is kept; one left to the rows' bytes would be merged into one task.
    assert "REPARTITION_BY_NUM" in pairs._jdf.queryExecution().toString()
    assert pairs.select("product1", "product2").distinct().count() == 1200


def test_box_stats_count_outliers_where_rows_lie(spark):
    from larder.operators.aggregates import box_stats
    df = spark.createDataFrame([("ab"[i % 2], float(i % 40)) for i in range(200)] + [("a", 1e6)], "g string, v double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = box_stats(df, "g", "v", exact=False)
        assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
        assert {r["g"]: r["n_outliers"] for r in out.collect()} == {"a": 1, "b": 0}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_relevance_cuts_products_before_they_meet_scenarios(spark):
    from larder.operators import ranking as R
    rows = [(i, f"n{i % 7}" if i % 3 else f"u{i}", "ABC"[i % 5 % 3] if i % 11 else None, str(i % 4 + 1)) for i in range(600)]
    prod = spark.createDataFrame(rows, "code int, product_name string, category_searched string, nova_group string")
    scen = [(s, f"n{s % 7}" if s % 4 else None, "ABC"[s % 3] if s % 5 else None, str(s % 4 + 1)) for s in range(40)]
    sc = spark.createDataFrame(scen, "scenario_id long, test_product string, test_category string, test_nova string")
    rel = R.relevance(prod, sc)
    want = set()
    for s, name, cat, nova in scen:
        held = {r[1] for r in rows if cat is not None and r[2] == cat}
        same = [r[1] for r in rows if cat is not None and r[2] == cat and r[1] != name][:10]
        other = [r[1] for r in rows if r[3] == nova and r[1] != name and r[1] not in held][:15]
        want |= {(s, i, 3) for i in same} | {(s, i, 2) for i in other}
    got = [tuple(r) for r in rel.select("scenario_id", "item", "rel").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    # Both lists are cut once before and once after they meet the scenarios.
    assert rel._jdf.queryExecution().optimizedPlan().toString().count("WindowGroupLimit") == 4


def test_diversity_keeps_the_listed_rows_only(spark, monkeypatch):
    from larder.operators import ranking as R
    kept, cut = [], R.cut_lineage
    monkeypatch.setattr(R, "cut_lineage", lambda df: kept.append(df.count()) or cut(df))
    weights = spark.createDataFrame([(i, t, 0.70710678) for i in range(300) for t in ("x", f"t{i // 2}")], "code int, term string, weight double")
    seen = spark.createDataFrame([(0, 1), (0, 4), (0, 1)], "ka int, kb int")
    sims = R.pair_similarity(weights, seen, "code")
    assert sorted((r["ka"], r["kb"], round(r["sim"], 6)) for r in sims.collect()) == [(0, 1, 1.0), (0, 4, 0.5)]
    assert kept == [6]  # two terms of each listed item; the matrix has 600 rows


def test_terms_of_a_document_are_counted_where_its_text_lies(spark, tmp_path):
    from larder.operators.tfidf import term_counts
    from larder.sources.tables import documents_by_key
    rows = [(1, "The fox and the fox"), (1, "A fox"), (2, None), (3, "Be the owl"), (None, "owl")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    counts = term_counts(documents_by_key(spark, str(tmp_path)), "doc_id", "text", stop_words=["the", "and", "be"])
    assert {tuple(r) for r in counts.collect()} == {(1, "fox", 3), (3, "owl", 1), (None, "owl", 1)}
    plan = counts._jdf.queryExecution()
    assert plan.executedPlan().toString().count("hashpartitioning(doc_id") == plan.executedPlan().toString().count("hashpartitioning(")
    assert "array_contains" not in plan.toString()  # a hash set, not a scan of the list per word


def test_grid_finds_the_nearest_of_all_tasks(spark, monkeypatch):
    from larder.operators import ranking as R
    monkeypatch.setattr(R, "_GRID_PER_TASK", 20)
    monkeypatch.setattr(R, "_GRID_STEP", 7)
    rows = [(i, t, 1 + (i * j) % 3) for i in range(90) for j, t in enumerate("abcdefgh") if (i + j) % 3]
    tf = spark.createDataFrame([*rows, (None, "a", 1)], "code int, term string, tf long")
    df = {t: sum(r[1] == t for r in rows) for t in "abcdefgh"}
    ranking = [{"lo": lo, "hi": 1.0, "_r": i + 1, "term": t, "df": df[t]} for lo in (1, 2) for i, t in enumerate("hgfedcba"[lo - 1:])]
    targets = spark.createDataFrame([(3,), (50,)], "code int")
    found = R._grid_nearest(tf, "code", 90, ranking, [(1, 1.0), (2, 1.0)], [2, 5], targets, 4)
    got = {}
    for r in found.collect():
        got.setdefault((r["config"], r["a"]), []).append((-round(r["sim"], 9), r["b"]))
    counts = {}
    for k, t, n in rows:
        counts.setdefault(k, {})[t] = n
    for config in range(4):
        terms = "hgfedcba"[config // 2:][:(2, 5)[config % 2]]
        w = {k: np.array([c.get(t, 0) * (np.log(91 / (1 + df[t])) + 1) for t in terms]) for k, c in counts.items()}
        for a in (3, 50):
            sims = sorted((-round(float(v @ w[a] / np.sqrt(v @ v)), 9), k) for k, v in w.items() if k != a and v @ w[a] > 0)
            assert [(round(s, 6), k) for s, k in sorted(got.get((config, a), []))[:4]] == [(round(s, 6), k) for s, k in sims[:4]]


def test_drawn_pairs_do_not_pass_the_driver(spark):
    df = spark.range(3000).selectExpr("id as code", "'a' as category_searched")
    pairs = P.category_pairs(df)
    pairs.collect()  # a few chunks stand for 30,000 pairs, and the plan is made anew once they are counted
    final = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in final and "BroadcastHashJoin" not in final


def test_similar_rows_do_not_pass_the_driver(spark, monkeypatch):
    from larder.operators import tfidf as T
    monkeypatch.setattr(T, "size_checked_broadcast", lambda df: df, raising=False)  # as with a large vocabulary
    docs = spark.range(300).selectExpr("id as code", "concat('w', id % 7, ' x', id % 11, ' z', id % 2) as text")
    w, _ = T.tfidf(docs, "code", "text", with_df=True)
    near = T.cosine_topk_of(w, docs.where("code % 50 = 0").select("code"), "code", 3)
    assert near.count() == 18
    for df in (w, near):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
