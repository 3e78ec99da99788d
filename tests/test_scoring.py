"""Literal cases of E-numbers, additives, processing score, labels, badges."""

import re

from pyspark.sql import functions as F

from larder.functions import fixed
from larder.functions import scoring as S
from tests.conftest import one


def test_e_numbers(spark):
    texts = ["Pears, E202, juice, e224", "E965ii E1442 E99", "no code: EE330 or E33", "", None, "xE440 E440x", "(E476)/E476;E1105b"]
    rule = re.compile(r"\bE\d{3,4}[a-z]?\b", re.IGNORECASE)
    got = one(spark, S.e_number_count(F.col("t")), "t string", [(t,) for t in texts])
    assert got == [len(rule.findall(t or "")) for t in texts]


def test_additives(spark):
    names = [a for a, _ in fixed.CONCERNING_ADDITIVES]
    rows = [(" + ".join(n.upper() for n in names),), (f"Plums, {names[3]}/{names[0]}",), ("Plums, thyme, stone-ground rye",), (None,)]
    got = one(spark, F.transform(S.concerning_additives(F.col("t")), lambda x: x["additive"]), "t string", rows)
    assert got == [names, [n for n in names if n in rows[1][0].lower()], [], []]


def expected_score(nova, text):
    """NOVA part, 5 per E-number up to 30, 6 per additive up to 30, 100 at most."""
    base = 20 if nova is None or nova == 0 else (nova - 1) * 13
    additives = sum(a in text.lower() for a, _ in fixed.CONCERNING_ADDITIVES)
    return min(base + min(5 * len(re.findall(r"\bE\d{3,4}[a-z]?\b", text, re.I)), 30) + min(6 * additives, 30), 100)


def test_processing_score_numeric_nova(spark):
    many = ", ".join([f"E{n}" for n in range(400, 412)] + [a for a, _ in fixed.CONCERNING_ADDITIVES])
    rows = [(1, "Plums"), (2, "Plums, E220"), (3, "Rye, E471, E282"), (4, many), (2, many), (None, "Rye"), (0, "Rye")]
    got = one(spark, S.processing_score(F.col("n"), F.col("t"), numeric_nova=True), "n int, t string", rows)
    assert got == [expected_score(*r) for r in rows]


def test_processing_score_text_nova(spark):
    rows = [("4", ""), ("unknown", ""), ("4.0", ""), ("0", ""), (None, ""), ("", "")]
    got = one(spark, S.processing_score(F.col("n"), F.col("t")), "n string, t string", rows)
    assert got == [39, 20, 20, -13, 20, 20]


def test_nova_labels(spark):
    rows = [("1",), ("2",), ("3",), ("4",), (None,), ("5",), ("foo",)]
    assert one(spark, S.nova_label(F.col("n")), "n string", rows) == [
        "Unprocessed/Minimal", "Processed Culinary", "Processed", "Ultra-Processed", "Unknown", "Unknown", "Unknown"]


def test_badges(spark):
    rows = [(15,), (20,), (21,), (40,), (41,), (60,), (61,), (80,)]
    assert one(spark, S.processing_badge(F.col("s")), "s int", rows) == ["🟢", "🟢", "🟡", "🟡", "🟠", "🟠", "🔴", "🔴"]
    labels = one(spark, S.processing_label(F.col("s")), "s int", rows)
    assert "Minimal" in labels[0] and "Highly" in labels[-1]


def test_healthiness_is_exact_integer_form(spark):
    rows = [(3, 1, 0, 0), (20, 4, 10, 5), (None, None, 2, 1), (40, 2, 15, 9)]
    got = one(spark, S.healthiness_score(F.col("c"), F.col("n"), F.col("e"), F.col("a")),
              "c int, n int, e int, a int", rows)
    ref = []
    for c, n, e, a in rows:
        c = 20 if c is None else c
        n = 4 if n is None else n
        v = min(c / 20 * 100, 100) * 0.4 + (n - 1) / 3 * 100 * 0.3 + min(e / 10 * 100, 100) * 0.2 + min(a / 5 * 100, 100) * 0.1
        ref.append(round(v, 2))
    assert got == ref
