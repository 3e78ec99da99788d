"""Operator 6 against brute force."""

import hashlib
import random

import pytest
from pyspark.sql import types as T

from larder.llm import content_sort


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, keep):
    groups = {}
    for doc, text in rows:
        groups.setdefault(lowered(text), []).append(doc)
    best = {}
    for body, ids in groups.items():
        known = [i for i in ids if i is not None]
        best[body] = (max(known) if keep == "max" else min(known)) if known else None
    return sorted(((doc, best[lowered(text)], len(groups[lowered(text)]), hashlib.sha256(lowered(text).encode()).hexdigest())
                   for doc, text in rows), key=str)


def table(spark, rows, partitions=3):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)


def cases():
    rng = random.Random(5)
    rows = [(n, rng.choice(["a", "A", "b", "Ä", "ä", "", None, "same head " * 20 + str(n % 7), "x" * 5000])) for n in range(300)]
    rows += [(1000 + n, "hot copy of many") for n in range(400)] + [(3, "twice"), (3, "twice"), (None, "twice"), (None, "alone")]
    return rows


@pytest.mark.parametrize("keep", ["min", "max"])
@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_groups_equal_brute_force(spark, keep, partitions):
    rows = cases()
    out = content_sort.content_groups(table(spark, rows), keep=keep, partitions=partitions).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out), key=str) == brute(rows, keep)
    kept = {}
    for r in out:
        if r.kept:
            assert r.doc_id == r.keep_id
            kept[r.text_sha256] = kept.get(r.text_sha256, 0) + 1
    assert set(kept.values()) == {1} and len(kept) == len({r.text_sha256 for r in out})


def test_rows_that_stay_keep_their_columns(spark):
    rows = [(n, t, f"s{n}", n) for n, (_, t) in enumerate(cases())]
    df = spark.createDataFrame(rows, "doc_id long, text string, run_ string, first_ int").repartition(4)
    out = content_sort.distinct_contents(df, keep="max", partitions=9)
    assert out.schema == T.StructType([f for f in df.schema])
    want = {}
    for r in rows:
        want[lowered(r[1])] = r
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want.values(), key=str)


def test_empty_table_and_wrong_parameter(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert content_sort.content_groups(df).count() == 0
    assert content_sort.distinct_contents(df).count() == 0
    with pytest.raises(ValueError):
        content_sort.content_groups(df, keep="first")
