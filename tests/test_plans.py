"""Physical-plan properties the scale design relies on."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

PLAN_ONLY = sorted(entry.oracle_sql())


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLAN_ONLY)
def test_no_cartesian_product(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_recommender_plan_shape(spark):
    df = entry.queries()["alternatives_top3"](spark, SF_SMALL)
    df.count()  # materialise the adaptive plan
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan


def test_shortlists_are_cut_before_the_shuffle(spark):
    from larder.operators.alternatives import scope_shortlists
    rows = spark.createDataFrame([("c", "n", n, n % 7) for n in range(20)], "scope string, name string, k int, score int")
    short = scope_shortlists(rows, "scope", "name", ["score", "k"], 3, [])
    assert "WindowGroupLimit" in short._jdf.queryExecution().toString()
    assert [tuple(x) for x in short.first()["shortlist"]] == [(0, 0), (0, 7), (0, 14)]


def test_scan_is_pruned(spark):
    plan = _plan(entry.queries()["processing_score"](spark, SF_SMALL))
    assert "ReadSchema" in plan and "p_retailprice" not in plan


def test_similarity_joins_heads_only(spark):
    from larder.operators.topk import similar_pairs
    # 300 documents share one frequent term each and pair up on rare ones.
    rows = [(d, t, w) for d in range(300) for t, w in (("common", 0.3), (f"rare{d // 2}", 0.9539392014169457))]
    pairs = similar_pairs(spark.createDataFrame(rows, "k int, term string, weight double"), "k", 0.8)
    assert sorted((r["a"], r["b"], round(r["sim"], 6)) for r in pairs.collect()) == [(2 * i, 2 * i + 1, 1.0) for i in range(150)]
