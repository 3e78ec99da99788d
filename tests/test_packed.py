"""Weighed documents as packed rows, and similar documents of a whole table."""

import math
import re
from collections import Counter

import pytest


def _docs(spark, keys):
    words = ["salt", "Zucker", "e330", "öl", "x", "milk_2", "rare"]
    texts = [None if i % 13 == 0 else " ".join(words[(i * j) % 7] for j in range(1, 2 + i % 6)) + f" w{i % 9}" for i in range(len(keys))]
    return spark.createDataFrame(list(zip(keys, texts, strict=True)), "k long, text string").repartition(3)


@pytest.mark.parametrize("held", [0, 8_000_000])
@pytest.mark.parametrize("keys", [list(range(40)), [i % 17 if i % 5 else None for i in range(40)]])
def test_packed_rows_equal_weights(spark, monkeypatch, keys, held):
    from larder.operators import tfidf as T
    monkeypatch.setattr(T, "HELD_TERMS", held)
    docs = _docs(spark, keys)
    want = {r["k"]: r for r in T.packed_rows(T.tfidf(docs, "k", "text", max_df=0.5, with_df=True)[0], "k").collect()}
    got = {r["k"]: r for r in T.packed_tfidf(docs, "k", "text", 0.5).collect()}
    assert set(got) == set(want) and None not in got
    for k, r in got.items():
        assert r["t"] == want[k]["t"] and all(math.isclose(x, y) for x, y in zip(r["v"], want[k]["v"], strict=True))


def test_weighed_documents_are_not_shuffled(spark):
    from larder.operators.tfidf import packed_tfidf
    docs = spark.range(50).selectExpr("id as k", "concat('a', id % 7, ' b', id % 5) as text")
    assert "Exchange" not in packed_tfidf(docs, "k", "text", 0.5)._jdf.queryExecution().executedPlan().toString()


def test_rows_are_not_copied_for_the_blocks_they_meet(spark, monkeypatch):
    from larder.operators import sparse_cells as S
    monkeypatch.setattr(S, "LEAST_ENTRIES", 20)
    rows = spark.range(90, numPartitions=6).selectExpr("id as k", "array(id % 10, 100 + id % 3) as t", "array(0.6D, 0.8D) as v")
    packed = []
    cut = S.cut_lineage
    monkeypatch.setattr(S, "cut_lineage", lambda df: packed.append(cut(df)) or packed[-1])
    pairs = S.close_pairs(rows, 0.9)
    got = [tuple(sorted(r[:2])) for r in pairs.collect()]
    assert sorted(got) == [(a, b) for a in range(90) for b in range(a + 1, 90) if (b - a) % 30 == 0]
    assert packed[0].count() == 6
    assert "Exchange" not in pairs._jdf.queryExecution().executedPlan().toString()


def test_every_document_asks_for_similar_ones(spark, tmp_path):
    from larder.plans.registry import QUERIES, load_all
    load_all()
    texts = [" ".join(f"w{(i * j) % 11}" for j in range(1, 3 + i % 4)) for i in range(60)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    tf = [Counter(re.findall(r"\w{2,}", t)) for t in texts]
    df = Counter(t for c in tf for t in c)
    w = [{t: n * (math.log(61 / (1 + df[t])) + 1) for t, n in c.items() if df[t] <= 30} for c in tf]
    w = [{t: x / math.sqrt(sum(y * y for y in r.values())) for t, x in r.items()} for r in w]
    want = set()
    for a, r in enumerate(w):
        near = [(-round(sum(x * o.get(t, 0) for t, x in r.items()), 9), b) for b, o in enumerate(w) if b != a and r.keys() & o.keys()]
        want |= {(a, i + 1, b) for i, (_, b) in enumerate(sorted(near)[:5])}
    got = {(r["doc_id"], r["rank"], r["similar_doc_id"]) for r in QUERIES["similar_documents"](spark, str(tmp_path)).collect()}
    assert got == want and len({a for a, _, _ in got}) > 50
