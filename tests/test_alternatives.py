"""Healthier alternatives on a small frame, and brute force on the catalogue."""


from larder.operators.alternatives import healthier_alternatives
from larder.operators.scoring import score_catalogue

ROWS = [
    (11, "Neon Fizz", "Drinks", 4, "Corn syrup, E102, E211, taurine", "Volt", 12.0, 0.1),
    (12, "Oat Drink", "Drinks", 3, "Oats, sunflower oil, E340", "Mill", 4.0, 0.1),
    (13, "Birch Sap", "Drinks", 1, "Birch sap", "Grove", 0.5, 0.0),
    (14, "Neon Fizz", "Drinks", 1, "Mislabelled", "Volt", 1.0, 0.0),
    (15, "Rye Crisp", "Bread", 1, "Rye", "Mill", 0.2, 0.9),
]
SCHEMA = ("code long, product_name string, category_searched string, nova_group int, ingredients_text string, "
          "brand string, sugar_100g double, salt_100g double")


def test_small_frame(spark):
    df = score_catalogue(spark.createDataFrame(ROWS, SCHEMA), numeric_nova=True)
    scores = {r["code"]: r["processing_score"] for r in df.collect()}
    assert scores[13] == scores[14] == scores[15] == 0 and 0 < scores[12] < scores[11]
    alts = {}
    for r in healthier_alternatives(df, top_n=3).collect():
        alts.setdefault(r["code"], []).append((r["rank"], r["alt_code"], r["score_improvement"]))
    # Not its own name, not another category, the lowest score first.
    assert sorted(alts[11]) == [(1, 13, scores[11]), (2, 12, scores[11] - scores[12])]
    assert sorted(alts[12]) == [(1, 13, scores[12]), (2, 14, scores[12])]
    assert sorted(alts[13]) == [(1, 14, 0)]  # nothing is strictly lower: equal ones come in
    assert 15 not in alts


def test_matches_brute_force(spark):
    from larder.sources.tables import catalogue
    from tests.conftest import SF_SMALL
    scored = score_catalogue(catalogue(spark, SF_SMALL)).select(
        "code", "product_name", "category_searched", "processing_score").collect()
    got = {(r["code"], r["rank"], r["alt_code"]) for r in
           healthier_alternatives(score_catalogue(catalogue(spark, SF_SMALL)), top_n=3).collect()}
    want = set()
    for p in scored:
        cands = [c for c in scored if c["category_searched"] == p["category_searched"]
                 and not (p["product_name"] is not None and c["product_name"] == p["product_name"])
                 and c["processing_score"] <= p["processing_score"]]
        strict = [c for c in cands if c["processing_score"] < p["processing_score"]]
        pick = sorted(strict or cands, key=lambda c: (c["processing_score"], c["code"]))[:3]
        want |= {(p["code"], i + 1, c["code"]) for i, c in enumerate(pick)}
    assert got == want
