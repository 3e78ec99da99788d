"""Literal cases of the ingredient parser (tokenise, normalise, pipeline)."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larder.functions import fixed
from larder.functions import text as X
from tests.conftest import one


def tok(spark, texts):
    return one(spark, X.tokenize(F.col("t")), "t string", [(t,) for t in texts])


def test_simple_split(spark):
    assert tok(spark, ["Lentils, Tamarind, Jaggery", "Quinoa"]) == [["Lentils", "Tamarind", "Jaggery"], ["Quinoa"]]


def test_empty_null_and_separators_only(spark):
    assert tok(spark, ["", None, " , ,, "]) == [[], [], []]


def test_commas_inside_parens_kept(spark):
    out = tok(spark, ["Chickpeas (soaked, boiled), Tahini (7%), Lemon",
                      "Rye, Seeds (flax, poppy), Raising Agent (E500, E503ii), Malt"])
    assert out == [["Chickpeas (soaked, boiled)", "Tahini (7%)", "Lemon"],
                   ["Rye", "Seeds (flax, poppy)", "Raising Agent (E500, E503ii)", "Malt"]]


def test_whitespace_and_unicode(spark):
    out = tok(spark, ["\tOats  ,  Barley\n,  Hops  ", "Jalapeño, Açaí, Smörgås", "Umeboshi,梅酢"])
    assert out == [["Oats", "Barley", "Hops"], ["Jalapeño", "Açaí", "Smörgås"], ["Umeboshi", "梅酢"]]


def test_only_the_next_parenthesis_counts(spark):
    out = tok(spark, ["Paste (Nuts (cashew, pecan)), Rice", "Dough (Spelt, Glaze (egg, milk)), Jam"])
    assert out == [["Paste (Nuts (cashew, pecan))", "Rice"], ["Dough (Spelt", "Glaze (egg, milk))", "Jam"]]


def norm(spark, items, synonyms=None):
    return one(spark, X.normalise(F.col("t"), synonyms), "t string", [(i,) for i in items])


def test_normalise_cases(spark):
    assert norm(spark, ["BARLEY", " Kelp ", "miso."]) == ["barley", "kelp", "miso"]
    assert norm(spark, list(fixed.DEFAULT_SYNONYMS)) == list(fixed.DEFAULT_SYNONYMS.values())
    assert norm(spark, [p + " sesame" for p in fixed.DEFAULT_SKIP_PREFIXES]) == [""] * len(fixed.DEFAULT_SKIP_PREFIXES)
    assert norm(spark, ["x", "..", ""]) == ["", "", ""]
    assert norm(spark, ["Nori sheet"], {"nori sheet": "seaweed"}) == ["seaweed"]


def test_pipeline(spark):
    text = ("Tofu (31%), Broth (Kelp, Shiitake), Noodles (Buckwheat (roasted), Salt), Ginger.,\nColour: Annatto, "
            "Contains soya, x")
    out = one(spark, X.parse_ingredients(F.col("t")), "t string", [(text,)])[0]
    assert out == ["tofu (31%)", "broth (kelp, shiitake)", "noodles (buckwheat (roasted), salt)", "ginger", "colour: annatto"]


def test_country_list_and_flags(spark):
    rows = [("Ireland, en:uk",), ("en:ie",), ("Northern Ireland",), (None,), ("",)]
    lists = one(spark, X.country_list(F.col("t")), "t string", rows)
    assert lists == [["ireland", "uk"], ["ie"], ["northern ireland"], [], []]
    exact = one(spark, X.sold_in_ireland_exact(F.col("t")), "t string", rows)
    like = one(spark, X.sold_in_ireland_like(F.col("t")), "t string", rows)
    assert exact == [True, True, False, False, False]
    assert like == [True, True, True, None, False]


def test_count_ingredients(spark):
    out = one(spark, X.count_ingredients(F.col("t")), "t string",
              [("Rye, Kelp, Hops, Malt",), ("Dates (90%)",), ("Dough (Spelt, Yeast), Figs, ab",), ("",), (None,)])
    assert out == [4, 1, 2, None, None]


_PY = re.compile(r",\s*(?![^()]*\))")


@settings(max_examples=120, deadline=None)
@given(st.lists(st.text(alphabet="ab ()(),,\t\n", min_size=0, max_size=40), min_size=1, max_size=25))
def test_tokeniser_matches_python_re(spark, texts):
    got = tok(spark, texts)
    want = [[p.strip() for p in _PY.split(t) if p.strip()] for t in texts]
    assert got == want


@settings(max_examples=25, deadline=None)
@given(st.lists(st.sampled_from([", ", ",", "(", ")", " ", "aa", "b(c", "d)", "\n"]), min_size=900, max_size=2600))
def test_long_texts_match_python_re(spark, parts):
    text = "".join(parts) + "x" * 400  # both sides of the 2,000 characters where the path changes
    assert tok(spark, [text]) == [[p.strip() for p in _PY.split(text) if p.strip()]]
