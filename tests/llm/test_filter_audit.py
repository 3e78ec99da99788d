"""Operator 12 against counting every order document by document."""

import random
import re
from itertools import permutations

import pytest

from larder.llm import filter_audit as A

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def fails(rows):
    """The set of filters that each (doc_id, text, lang) fails."""
    out = []
    for doc, text, _ in rows:
        t = text or ""
        words = WORDS.findall(t)
        smaller = doc is not None and any(d is not None and d < doc and (u or "") == t for d, u, _ in rows)
        out.append({n for n, bad in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            bool(re.search(r"[#$%&*|]", t)), smaller), strict=True) if bad})
    return out


def brute(rows, labels):
    failed = fails(rows)
    good, toxic = ({d for d, *v in labels if d is not None and v[n] == 1} for n in (0, 1))
    out = {}
    for part in {lang or "" for *_, lang in rows}:
        own = [(r[0], f) for r, f in zip(rows, failed, strict=True) if (r[2] or "") == part]
        for order in map("".join, permutations("ABCDE")):
            alive = list(own)
            for step, name in enumerate(order, 1):
                gone = [(d, f) for d, f in alive if name in f]
                every = sum(name in f for _, f in own)
                alive = [(d, f) for d, f in alive if name not in f]
                out[part, order, step] = [len(alive), len(gone), every - len(gone), sum(f == {name} for _, f in own),
                                          sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)]
        for name in "ABCDE":
            total = sum(out[part, o, o.index(name) + 1][1] for o in map("".join, permutations("ABCDE")))
            for o in map("".join, permutations("ABCDE")):
                out[part, o, o.index(name) + 1].append(total)
    return out


def table(seed=4):
    rng = random.Random(seed)
    words = [f"word{n}" for n in range(700)] + ["Über", "naïve x", "x\x85y", "日本"]

    def text():
        t = [rng.choice(words) for _ in range(rng.choice([0, 1, 150, 199, 200, 201, 400]))]
        if rng.random() < 0.3:
            t += ["same"] * len(t)
        if rng.random() < 0.3:
            t += [rng.choice(["A$", "50%", "a|b"])]
        if rng.random() < 0.3:
            t += ["LOUD" * 40]
        return rng.choice([" ", "\n", "\t \x0b"]).join(t)

    rows = [(n, text(), rng.choice(["en", "de", "", None])) for n in range(60)]
    rows += [(100 + n, rows[n % 7][1], rng.choice(["en", "fr"])) for n in range(40)]
    rows += [(200, None, "en"), (201, "", "en"), (202, " \n", None), (None, "nobody", "en"), (None, "nobody", "en"), (203, "nobody", "en")]
    rows += [rows[3], rows[3], rows[61], (None, None, None), (204, "w " * 200_000 + "end", "en")]
    labels = [(n, n % 3 % 2, int(n % 5 == 0)) for n in range(0, 120, 2)] + [(4, 1, 1), (None, 1, 1), (6, None, None)]
    return rows, labels


def test_equals_brute_force(spark):
    rows, labels = table()
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, lang string, part string, n int").repartition(5)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
           for r in A.audit(docs, marks).collect()}
    assert got == brute(rows, labels)


def test_empty_table_and_no_labels(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert A.audit(docs, marks).collect() == []
    one = A.audit(spark.createDataFrame([(1, "x", "en")], docs.schema), marks).collect()
    assert len(one) == 600 and all(r.good_lost == r.toxic_lost == 0 for r in one)


@pytest.mark.parametrize("n", [1, 2**32, 2**62])
def test_fields_never_flow_over(n):
    code = 0b10101 | A.GOOD
    by_kind, unique = A.unpack(n * A.packed(code) + n * A.packed(0))
    for o, order in enumerate(A.ORDERS):
        gone = False
        for s, name in enumerate(order):
            bad = name in "ACE"
            assert by_kind[1, o, s] == (n if bad and not gone else 0)
            assert by_kind[3, o, s] == by_kind[1, o, s] and by_kind[4, o, s] == 0
            gone |= bad
            assert by_kind[0, o, s] == (n if gone else 2 * n if n < 2**62 else by_kind[0, o, s])
    assert not unique.any()


def test_many_parts_are_handed_on(spark, monkeypatch):
    rows = [(n, "x", f"p{n % 600}") for n in range(1300)]
    got = A.audit(spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1),
                  spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    counts = {r.part: r.n for r in got.filter("filter_order = 'ABCDE' and step = 1").selectExpr("part", "kept + removed as n").collect()}
    assert len(counts) == 600 and sum(counts.values()) == 1300
