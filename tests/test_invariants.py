"""Invariants for ingest, statistics and fitted models."""

import math

import pytest

from pyspark.sql import functions as F

from larder.operators import hypothesis as H
from larder.operators.cluster_metrics import adjusted_rand_index
from larder.sources import ingest as I


def test_upsert_last_wins(spark):
    existing = spark.createDataFrame([("a", 1, "old"), ("b", 1, "old")], "code string, page int, v string")
    incoming = spark.createDataFrame([("b", 2, "new1"), ("b", 3, "new2"), ("c", 2, "new")],
                                     "code string, page int, v string")
    out = {r["code"]: r["v"] for r in I.upsert(existing, incoming, "code", ["page"]).collect()}
    assert out == {"a": "old", "b": "new2", "c": "new"}


def test_refresh_scoped_and_full(spark):
    cols = "code string, category_searched string, page int"
    existing = spark.createDataFrame([("a", "Soup", 1), ("b", "Jam", 1)], cols)
    incoming = spark.createDataFrame([("c", "Soup", 2), ("d", "Jam", 2)], cols)
    scoped = sorted(r["code"] for r in I.refresh(existing, incoming, ["Soup"]).collect())
    assert scoped == ["b", "c"]
    full = sorted(r["code"] for r in I.refresh(existing, incoming, full_refresh=True).collect())
    assert full == ["c", "d"]


def test_invalid_categories(spark):
    df = spark.createDataFrame([("Soup",), ("Cakes",), ("Cakes",)], "category_searched string")
    assert [r[0] for r in I.invalid_categories(df).collect()] == ["Cakes"]


def test_clean_raw_products(spark):
    raw = spark.createDataFrame(
        [("1", "", "B", "4", "Water, salt", ("", "1.5", None), "en:ie", None, "0", None, None, None),
         ("", "X", "B", "4", "Water", ("1", "1", "1"), "", None, None, None, None, None),
         ("3", "Y", None, None, "", ("1", "1", "1"), "", None, None, None, None, None)],
        I.RAW_PRODUCT_SCHEMA).withColumn("category", F.lit("Soup"))
    out = I.clean_raw_products(raw).collect()
    assert len(out) == 1
    r = out[0]
    assert (r["product_name"], r["sugar_100g"], r["salt_100g"], r["fat_100g"], r["ecoscore_score"]) == \
        ("Unknown", 0.0, 1.5, 0.0, None)


def test_csv_roundtrip_and_missing(spark, tmp_path):
    from larder.sources.tables import PRODUCT_SCHEMA
    missing = I.read_products_csv(spark, str(tmp_path / "none.csv"))
    assert missing.count() == 0 and missing.schema == PRODUCT_SCHEMA


def test_json_field(spark):
    df = spark.createDataFrame([('{"k": 5}',), ("{}",), (None,)], "p string")
    assert [r["k"] for r in I.extract_json_field(df, "p", "k", "k").collect()] == [5, None, None]


def test_ari_identity_and_independence(spark):
    df = spark.createDataFrame([(i % 3, i % 3) for i in range(30)], "a int, b int")
    assert abs(adjusted_rand_index(df, "a", "b").first()["ari"] - 1.0) < 1e-12


def test_t_distribution_table_values():
    assert abs(H.t_sf_two_sided(2.228138852, 10) - 0.05) < 1e-9
    assert abs(H.t_quantile(0.975, 10) - 2.228138852) < 1e-6
    assert abs(H.f_sf(3.492828, 2, 20) - 0.05) < 1e-6
    assert abs(H.t_sf_two_sided(0.0, 5) - 1.0) < 1e-12


def test_ttest_auto_welch(spark):
    df = spark.createDataFrame([("x", float(v)) for v in (1, 2, 3, 4, 5)] + [("y", float(v)) for v in (2, 4, 6)],
                               "g string, v double")
    r = H.with_t_pvalue(H.ttest(H.group_summary(df, "g", "v", "x", "y"))).first()
    assert r["welch"] is True
    m1, m2, v1, v2 = 3.0, 4.0, 2.5, 4.0
    t = (m1 - m2) / math.sqrt(v1 / 5 + v2 / 3)
    assert abs(r["t"] - t) < 1e-12
    assert 0 < r["p_value"] < 1 and r["ci_low"] < m1 - m2 < r["ci_high"]


def test_gmm_probabilities_sum_to_one(spark):
    import __spark_entry__ as e
    from tests.conftest import SF_SMALL
    rows = e.queries()["gmm_probabilities"](spark, SF_SMALL).collect()
    assert rows and all(abs(sum(r["probability"]) - 1.0) < 1e-9 for r in rows)


def test_tfidf_grid_search_small(spark):
    from larder.operators.tfidf import cosine_topk_of, tfidf
    from larder.operators import ranking as R
    from larder.sources.tables import catalogue
    from tests.conftest import SF_SMALL
    prod = catalogue(spark, SF_SMALL)
    sc = R.create_scenarios(prod, 20)
    rel = R.relevance(prod, sc)
    sizes = dict(max_features=(20, 60), ngram_ranges=((1, 1), (1, 2)), min_dfs=(1, 2), max_dfs=(0.8,))
    got = {r["config"]: r for r in R.tfidf_grid_search(prod, sc, rel, n_eval=5, **sizes).collect()}
    assert sorted(got) == list(range(8))
    # One configuration by the general operators: two n-grams, min_df 2, 60 terms.
    text = F.lower(F.coalesce(F.nullif(F.col("ingredients_text"), F.lit("")), F.lit("unknown")))
    w, _ = tfidf(prod.select("code", text.alias("text")), "code", "text", max_df=0.8, min_df=2, max_features=60, ngram_range=(1, 2))
    some = sc.where("scenario_id <= 5")
    recs = (some.select("scenario_id", "code").join(cosine_topk_of(w, some, "code", 20), "code")
            .join(prod.select(F.col("code").alias("similar_code"), F.col("product_name").alias("item")), "similar_code"))
    cats = (prod.where("product_name is not null").groupBy("product_name").agg(F.min_by("category_searched", "code").alias("category"))
            .withColumnRenamed("product_name", "item"))
    rels = rel.join(some.select("scenario_id"), "scenario_id")
    want = R.metrics_per_scenario(recs.select("scenario_id", "rank", "item"), rels, some, cats, [10]).agg(F.avg("ndcg"), F.avg("recall")).first()
    assert got[7]["params"].startswith("max_features=60, ngram_range=(1, 2), min_df=2")
    assert math.isclose(got[7]["score"], want[0]) and math.isclose(got[7]["recall"], want[1])
    assert R.best_configuration(R.tfidf_grid_search(prod, sc, rel, n_eval=5, **sizes)).first()["score"] == max(r["score"] for r in got.values())


def brute_dbscan(rows, eps, min_samples):
    """{key: (cluster, is_core)} of dense rows {key: vector}."""
    import numpy as np
    keys = sorted(rows)
    x = np.array([rows[k] for k in keys])
    near = np.sqrt(np.maximum(0, ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))) <= eps + 1e-12
    core = near.sum(1) >= min_samples
    lab = {}
    for i in range(len(keys)):
        if core[i] and i not in lab:
            stack, comp = [i], {i}
            while stack:
                for m in np.nonzero(near[stack.pop()] & core)[0]:
                    if m not in comp:
                        comp.add(m)
                        stack.append(m)
            lab.update({c: min(keys[c] for c in comp) for c in comp})
    for i in range(len(keys)):
        if not core[i]:
            lab[i] = min((lab[m] for m in np.nonzero(near[i] & core)[0]), default=None)
    return {k: (lab[i], bool(core[i])) for i, k in enumerate(keys)}


def dbscan_frame(spark, zero_rows):
    """Random unit rows over few terms, some of them all-zero."""
    import numpy as np
    rng = np.random.default_rng(3)
    rows = {}
    for k in range(60):
        v = rng.random(6) * (rng.random(6) < 0.5)
        rows[k] = v / np.linalg.norm(v) if v.any() else v
    for k in range(60, 60 + zero_rows):
        rows[k] = np.zeros(6)
    w = spark.createDataFrame([(k, f"t{i}", float(x)) for k, v in rows.items() for i, x in enumerate(v) if x], "k int, term string, weight double")
    return rows, spark.createDataFrame([(k,) for k in rows], "k int"), w


@pytest.mark.parametrize("eps,min_samples,zero_rows", [(0.4, 3, 0), (0.6, 2, 3), (0.9, 5, 1), (1.2, 4, 2), (1.2, 70, 2), (1.3, 3, 0), (1.5, 5, 2), (1.5, 99, 0)])
def test_dbscan_matches_brute_force(spark, eps, min_samples, zero_rows):
    from larder.operators.dbscan import dbscan
    rows, keys, w = dbscan_frame(spark, zero_rows)
    got = {r["k"]: (r["cluster"], r["is_core"]) for r in dbscan(keys, w, "k", eps, min_samples).collect()}
    assert got == brute_dbscan(rows, eps, min_samples)


def test_dbscan_grid_equals_single_runs(spark):
    from larder.operators.dbscan import dbscan_grid
    rows, keys, w = dbscan_frame(spark, 2)
    got = dbscan_grid(keys, w, "k", [0.3, 0.6, 0.9, 1.5], [2, 4, 70]).collect()
    assert len(got) == 12
    for r in got:
        want = brute_dbscan(rows, r["eps"], r["min_samples"])
        clusters = {c for c, _ in want.values() if c is not None}
        noise = sum(c is None for c, _ in want.values())
        assert (r["n_clusters"], r["n_noise"], r["valid"]) == (len(clusters), noise, len(clusters) >= 2), r


@pytest.mark.parametrize("zero_rows", [0, 2])
def test_dbscan_grid_has_all_radii(spark, monkeypatch, zero_rows):
    from larder.operators import sparse_cells
    from larder.operators.dbscan import dbscan_grid
    monkeypatch.setattr(sparse_cells, "MOST_ROWS", 25)  # three blocks, so forests of several cells meet
    monkeypatch.setattr(sparse_cells, "HELD", 50)
    rows, keys, w = dbscan_frame(spark, zero_rows)
    got = dbscan_grid(keys, w, "k", [0.2, 0.5, 1.0, 1.2, 1.4, 1.5], [3, 9, 40]).collect()
    assert len(got) == 18
    for r in got:
        want = brute_dbscan(rows, r["eps"], r["min_samples"])
        clusters = {c for c, _ in want.values() if c is not None}
        noise = sum(c is None for c, _ in want.values())
        assert (r["n_clusters"], r["n_noise"], r["valid"]) == (len(clusters), noise, len(clusters) >= 2), r


def test_components_of_a_chain_of_300(spark):
    import random

    from larder.operators.components import connected_components
    order = list(range(300))
    random.Random(1).shuffle(order)
    edges = [(order[i], order[i + 1]) for i in range(299)] + [(900, 901)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {**{n: 0 for n in range(300)}, 900: 900, 901: 900}


def test_diagonal_mixture_finds_separate_groups(spark):
    import numpy as np
    from pyspark.ml.linalg import Vectors

    from larder.operators import models as M
    rng = np.random.default_rng(2)
    centres = [(0, 0), (8, 8), (-8, 8)]
    rows = [(i, Vectors.dense(rng.normal(centres[i % 3], (0.5, 1.0)))) for i in range(300)]
    df = spark.createDataFrame(rows, ["id", "features"])
    for spherical in (False, True):
        m = M.diagonal_mixture(df, 3, spherical)
        assert np.allclose(sorted(m["weights"]), [1 / 3] * 3, atol=0.02)
        out = M.diagonal_labels(df, m).collect()
        assert len({(r["id"] % 3, r["prediction"]) for r in out}) == 3
    best = M.gmm_selection(spark, df, (2, 4), ("diag",)).orderBy("bic").first()
    assert best["n_components"] == 3


def test_pca_equals_dense_computation(spark):
    import numpy as np
    from pyspark.ml.linalg import Vectors

    from larder.operators import models as M
    x = np.random.default_rng(5).normal(size=(40, 5)) * [3, 2, 1, 0.5, 0.1] + 7
    df = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(x)], ["id", "features"])
    coords, ratio = M.pca_2d(df, "id")
    got = np.array([[r["pca_x"], r["pca_y"]] for r in coords.orderBy("id").collect()])
    u, s, _ = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    assert np.allclose(np.abs(got), np.abs(u[:, :2] * s[:2]), atol=1e-6)
    assert np.allclose(ratio, (s ** 2 / (s ** 2).sum())[:2])


def test_kmeans_analysis_takes_the_best_run(spark):
    from larder.operators import models as M
    runs = spark.createDataFrame([(2, 0, 0.3, 9.0, 5.0), (2, 1, 0.5, 8.0, 6.0), (2, 2, 0.5, 7.0, 4.0), (3, 0, 0.1, 1.0, 2.0)],
                                 "k int, run int, silhouette double, calinski_harabasz double, inertia double")
    rows = {r["k"]: r for r in M.best_runs(runs).collect()}
    assert (rows[2]["silhouette"], rows[2]["calinski_harabasz"], rows[2]["inertia"]) == (0.5, 8.0, 6.0)
    assert rows[3]["stability"] == 0.0


def test_land_and_ingest_pages_dedupes(spark, tmp_path):
    rows = [(1, "A", "B", "4", "Water, salt", 1.0, 0.5, 2.0, "en:ie", "Soup"),
            (2, "C", "B", "1", "Oats", None, 0.1, 1.0, "en:ie", "Soup")]
    schema = ("code long, product_name string, brand string, nova_group string, ingredients_text string, "
              "sugar_100g double, salt_100g double, fat_100g double, countries_sold string, category_searched string")
    df = spark.createDataFrame(rows, schema)
    landing = str(tmp_path / "landing")
    I.land_pages(df, landing, page_size=1)
    out = {r["code"]: r for r in I.ingest_pages(spark, landing).collect()}
    assert set(out) == {"1", "2"} and out["2"]["sugar_100g"] == 0.0


def test_sinks_roundtrip(spark, tmp_path):
    from larder.operators.models import load_pipeline, save_model
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import Tokenizer
    df = spark.createDataFrame([("1", "Soup"), ("2", "Jam")], "code string, category_searched string")
    I.write_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2
    I.write_report(I.update_log(df), str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).where("is_total = 1").first()["n"] == 2
    I.write_catalogue(df, str(tmp_path / "cat"))
    I.write_catalogue(df.where("category_searched = 'Soup'").selectExpr("'3' as code", "category_searched"),
                      str(tmp_path / "cat"))
    got = sorted(r["code"] for r in spark.read.parquet(str(tmp_path / "cat")).collect())
    assert got == ["2", "3"]  # dynamic overwrite replaced only the Soup partition
    model = Pipeline(stages=[Tokenizer(inputCol="code", outputCol="t")]).fit(df)
    save_model(model, str(tmp_path / "model"))
    assert load_pipeline(str(tmp_path / "model")).transform(df).count() == 2


def test_sampled_pairs_labels_match_categories(spark):
    from larder.operators.pairs import sample_pairs
    from larder.sources.tables import catalogue
    from tests.conftest import SF_SMALL
    cat = catalogue(spark, SF_SMALL)
    pairs = sample_pairs(spark, cat, 300, 1.0, seed=7).collect()
    assert 500 < len(pairs) <= 600
    drawn = [(*sorted((r["product1"], r["product2"])), r["label"]) for r in pairs]
    assert len(set(drawn)) == len(drawn)
    for r in pairs:
        assert (r["category1"] == r["category2"]) == (r["label"] == 1)
        assert r["product1"] != r["product2"]
    again = sample_pairs(spark, cat, 300, 1.0, seed=7).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, pairs))


def test_degenerate_inputs_give_null_not_errors(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 1.0), ("y", 1.0), ("y", 1.0)], "g string, v double")
    r = H.ttest(H.group_summary(df, "g", "v", "x", "y")).first()
    assert r["t"] is None and r["cohen_d"] is None
    one_group = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "g string, v double")
    assert H.anova(one_group, "g", "v").first()["f"] is None


def test_ingest_pages_last_page_wins(spark, tmp_path):
    landing = tmp_path / "landing"
    for page, name in ((1, "old"), (2, "new")):
        d = landing / "category=Soup" / f"page={page}"
        d.mkdir(parents=True)
        (d / "part.json").write_text(
            '{"code": "7", "product_name": "%s", "ingredients_text": "Water", "nutriments": {}}\n' % name)
    rows = I.ingest_pages(spark, str(landing)).collect()
    assert [(r["code"], r["product_name"], r["category_searched"]) for r in rows] == [("7", "new", "Soup")]


def test_stream_of_late_rows_equals_batch_and_restarts(spark, tmp_path):
    from larder.sources.ingest import latest_per_key
    from larder.streaming.ingest_stream import compact, current_table, run_upsert_stream
    landed, log, ckpt = (str(tmp_path / n) for n in ("landed", "log", "ckpt"))
    batches = [[(1, 5, "a"), (2, 1, "b")], [(1, 3, "late"), (3, 9, "c")], [(2, 7, "d"), (2, 6, "e")], [(1, 5, "b")]]
    schema = "k int, ts int, v string"
    rows = [r for b in batches for r in b]
    want = sorted(map(tuple, latest_per_key(spark.createDataFrame(rows, schema), "k", ["ts", "v"]).collect()))

    def run():
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landed)
        run_upsert_stream(source, log, "k", ["ts", "v"], ckpt)
        return sorted(map(tuple, current_table(spark, log, "k", ["ts", "v"]).collect()))
    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(landed)
    assert run() == want
    n = spark.read.parquet(log).count()
    assert run() == want and spark.read.parquet(log).count() == n  # restart: nothing new
    assert spark.read.parquet(log).select("_batch").distinct().count() >= 2
    spark.createDataFrame([(3, 1, "late"), (4, 1, "new")], schema).coalesce(1).write.mode("append").parquet(landed)
    assert run() == sorted([*want, (4, 1, "new")])
    compact(spark, log, str(tmp_path / "log2"), "k", ["ts", "v"])
    assert sorted(map(tuple, current_table(spark, str(tmp_path / "log2"), "k", ["ts", "v"]).collect())) == sorted([*want, (4, 1, "new")])


def test_refresh_keeps_keys_unique(spark):
    existing = spark.createDataFrame([("a", "Jam"), ("b", "Jam"), ("c", "Soup")], "code string, category_searched string")
    incoming = spark.createDataFrame([("b", "Soup", 1)], "code string, category_searched string, page int")
    rows = sorted(map(tuple, I.refresh(existing, incoming, ["Soup"]).collect()))
    assert rows == [("a", "Jam"), ("b", "Soup")]


def test_missing_csv_is_empty_and_other_errors_are_raised(spark, tmp_path):
    from pyspark.errors import AnalysisException
    assert I.read_products_csv(spark, str(tmp_path / "none.csv")).count() == 0
    with pytest.raises((AnalysisException, Exception), match="(?i)scheme"):
        I.read_products_csv(spark, "nosuchscheme://x/y.csv").count()


def test_csv_round_trip_of_odd_values(spark, tmp_path):
    from larder.sources.tables import PRODUCT_SCHEMA
    names = ['plain', 'a "quoted" one', 'comma, and\nnew line', '', None, "back\\slash"]
    rows = [tuple([str(i), n] + [None] * (len(PRODUCT_SCHEMA) - 2)) for i, n in enumerate(names)]
    I.write_csv(spark.createDataFrame(rows, PRODUCT_SCHEMA), str(tmp_path / "csv"))
    back = {r["code"]: r["product_name"] for r in I.read_products_csv(spark, str(tmp_path / "csv")).collect()}
    assert back == {str(i): n for i, n in enumerate(names)}


def test_positions_and_quantiles_equal_brute_force(spark):
    import random

    import numpy as np

    from larder.operators.positions import exact_quantiles, position_index
    rng = random.Random(4)
    rows = [(None if i < 150 else f"n{rng.randint(0, 20)}", i, rng.choice([None, float(rng.randint(0, 9)), rng.random()]),
             "hot" if i % 3 else rng.choice([None, "a", "b"])) for i in range(700)]
    df = spark.createDataFrame(rows, "name string, code int, v double, g string").repartition(5)
    pos = {r["code"]: r["pos"] for r in position_index(df, "code").collect()}
    assert pos == {i: i for i in range(700)}
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", [0.0, 0.25, 0.5, 0.9, 1.0]).collect()}
    for g in {r[3] for r in rows}:
        values = [r[2] for r in rows if r[3] == g and r[2] is not None]
        assert got[g]["n"] == len(values) and got[g]["min"] == min(values) and got[g]["max"] == max(values)
        assert np.allclose(got[g]["q"], np.quantile(values, [0, 0.25, 0.5, 0.9, 1]))


def test_product_index_with_leading_null_names(spark):
    from larder.operators.pairs import product_index
    rows = [(i, None if i < 150 else f"p{i % 7}") for i in range(300)]
    got = {r["product_name"]: r["product_idx"] for r in product_index(spark.createDataFrame(rows, "code int, product_name string")).collect()}
    assert got == {f"p{k}": max(i for i in range(150, 300) if i % 7 == k) for k in range(7)}


def test_size_checked_broadcast_respects_bound(spark):
    from larder.operators.joins import size_checked_broadcast
    big = spark.range(1000).withColumnRenamed("id", "k")
    small = size_checked_broadcast(spark.range(10).withColumnRenamed("id", "k"), 1000)
    over = size_checked_broadcast(spark.range(500).withColumnRenamed("id", "k"), 1000)
    assert "broadcast" in big.join(small, "k")._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "broadcast" not in big.join(over, "k")._jdf.queryExecution().optimizedPlan().toString().lower()
