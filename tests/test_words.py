"""Similar words and analogies against a brute force over all words."""

import numpy as np

from larder.operators import models as M


def _brute(units, vector, without, n):
    score = sorted((-round(float(u @ vector / np.linalg.norm(vector)), 9), w) for w, u in units.items() if w not in without)
    return [(w, i + 1) for i, (_, w) in enumerate(score[:n])]


def _words(spark):
    rng = np.random.default_rng(8)
    vectors = {f"w{i:02d}": rng.normal(size=4) for i in range(40)}
    vectors["w05"] = vectors["w03"] * 2  # a tie for every query
    vectors["zero"] = np.zeros(4)
    df = spark.createDataFrame([(w, v.tolist()) for w, v in vectors.items()], "word string, vector array<double>").repartition(4)
    return {w: v / np.linalg.norm(v) for w, v in vectors.items() if v.any()}, df


def test_similar_words(spark):
    units, df = _words(spark)
    asked = ["w03", "w05", "w20", "zero", "unknown", "w03"]
    queries = spark.createDataFrame([(w,) for w in asked], "word string")
    got = M.similar_words(df, queries, 6).collect()
    for q in ("w03", "w05", "w20"):
        assert sorted(((r.word, r["rank"]) for r in got if r.query == q), key=lambda r: r[1]) == _brute(units, units[q], {q}, 6)
    assert len(got) == 18 and M.similar_words(df, queries.limit(0), 6).count() == 0


def test_analogies(spark):
    units, df = _words(spark)
    asked = {"a": [("w01", 1), ("w02", 1), ("w03", -1)], "b": [("w10", 1), ("unknown", -1)], "c": [("unknown", 1)], "d": [("w05", 1), ("w03", 1)]}
    queries = spark.createDataFrame([(q, w, s) for q, parts in asked.items() for w, s in parts], "query string, word string, sign int")
    got = M.analogies(df, queries, 5).collect()
    for q, parts in asked.items():
        known = [s * units[w] for w, s in parts if w in units]
        want = _brute(units, np.mean(known, axis=0), {w for w, _ in parts}, 5) if known else []
        assert sorted(((r.word, r["rank"]) for r in got if r.query == q), key=lambda r: r[1]) == want
    assert M.analogies(df, queries.limit(0), 5).count() == 0
