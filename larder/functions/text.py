"""Ingredient-text Column builders.

Every function maps Columns to Columns built from Spark SQL functions, so the
work stays inside whole-stage code generation; no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.functions import fixed


# The linear tokeniser cuts after every parenthesis and marks the commas that
# split with a private-use character; texts of up to so many characters take
# the one regex, which is faster there and gives the same items.
PAREN_CUT_PATTERN = r"(?<=[()])"
SPLIT_MARK = "\ue000"
REGEX_SPLIT_MAX_CHARS = 2000


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unicode_trim(c) -> Column:
    """Trim all Unicode whitespace (Spark's ``trim`` only strips spaces)."""
    return F.regexp_replace(_col(c), fixed.UNICODE_TRIM_PATTERN, "")


def tokenize(text) -> Column:
    """split on commas outside parentheses, trim, drop empty items.

    NULL and '' give an empty array.
    """
    t = F.coalesce(_col(text), F.lit(""))
    # A comma splits unless the next parenthesis after it is ')'.  The
    # look-ahead regex rescans to the next paren for every comma (quadratic on
    # long texts), so the same rule is applied in linear time: cut the text
    # after every paren; a comma is protected exactly when its segment ends
    # with ')'; every other comma becomes a split mark.  Without any ')' the
    # plain split is already the answer; a text that contains the mark
    # itself falls back to the regex.
    segments = F.split(t, PAREN_CUT_PATTERN)
    marked = F.array_join(F.transform(segments, lambda seg: F.when(seg.endswith(")"), seg).otherwise(
        F.replace(seg, F.lit(","), F.lit(SPLIT_MARK)))), "")
    regex = F.split(t, fixed.INGREDIENT_SPLIT_PATTERN)
    # Short texts (ingredient lists) are split faster by the single regex,
    # whose rescans are bounded by the text length; long texts go linear.
    parts = (F.when(~t.contains(")"), F.split(t, fixed.PLAIN_SPLIT_PATTERN))
             .when((F.length(t) <= REGEX_SPLIT_MAX_CHARS) | t.contains(SPLIT_MARK), regex)
             .otherwise(F.split(marked, SPLIT_MARK)))
    return F.filter(F.transform(parts, unicode_trim), lambda x: x != "")


def _lookup(value: Column, mapping: Mapping[str, str]) -> Column:
    out = None
    for key, repl in mapping.items():
        out = F.when(value == key, F.lit(repl)) if out is None else out.when(value == key, F.lit(repl))
    return value if out is None else out.otherwise(value)


def normalise(item, synonyms: Mapping[str, str] | None = None,
              skip_prefixes: Iterable[str] | None = None) -> Column:
    """trim, lower-case, drop every '.', skip allergen statements, map
    synonyms, and give '' for anything of one character or less."""
    synonyms = fixed.DEFAULT_SYNONYMS if synonyms is None else synonyms
    skip_prefixes = fixed.DEFAULT_SKIP_PREFIXES if skip_prefixes is None else tuple(skip_prefixes)
    clean = F.replace(F.lower(unicode_trim(item)), F.lit("."), F.lit(""))
    skip = F.lit(False)
    for prefix in skip_prefixes:
        skip = skip | clean.startswith(prefix)
    mapped = _lookup(clean, synonyms)
    return F.when(skip, F.lit("")).when(F.length(mapped) > 1, mapped).otherwise(F.lit(""))


def parse_ingredients(text, synonyms: Mapping[str, str] | None = None,
                      skip_prefixes: Iterable[str] | None = None) -> Column:
    """tokenise then normalise, dropping skipped items."""
    normalised = F.transform(tokenize(text), lambda x: normalise(x, synonyms, skip_prefixes))
    return F.filter(normalised, lambda x: x != "")


def parse_ingredients_basic(text) -> Column:
    """the older parser (six synonyms, two skip prefixes)."""
    return parse_ingredients(text, fixed.BASIC_SYNONYMS, fixed.BASIC_SKIP_PREFIXES)


def split_naive(text) -> Column:
    """split on every comma, trim, lower-case, drop empty items."""
    parts = F.split(F.coalesce(_col(text), F.lit("")), ",")
    return F.filter(F.transform(parts, lambda x: F.lower(unicode_trim(x))), lambda x: x != "")


def count_ingredients(text) -> Column:
    """number of tokens longer than two characters; NULL for NULL/'' text."""
    t = _col(text)
    n = F.size(F.filter(tokenize(t), lambda x: F.length(x) > 2))
    return F.when(t.isNull() | (t == ""), F.lit(None).cast("int")).otherwise(n)


def country_list(raw) -> Column:
    """lower-case, drop 'en:', split on ',', trim (empty items kept);
    NULL/'' give an empty array."""
    r = _col(raw)
    parts = F.split(F.replace(F.lower(r), F.lit("en:"), F.lit("")), ",")
    return F.when(r.isNull() | (r == ""), F.array().cast("array<string>")).otherwise(
        F.transform(parts, unicode_trim))


def sold_in_ireland_exact(raw) -> Column:
    """Exact membership of 'ireland' or 'ie' in the cleaned country list."""
    lst = country_list(raw)
    out = F.lit(False)
    for tok in fixed.IRELAND_TOKENS:
        out = out | F.array_contains(lst, tok)
    return out


def sold_in_ireland_like(raw) -> Column:
    """``ILIKE '%Ireland%' OR ILIKE '%en:ie%'`` (NULL stays NULL, filters drop it)."""
    r = _col(raw)
    out = None
    for pattern in fixed.IRELAND_ILIKE:
        cond = r.ilike(pattern)
        out = cond if out is None else (out | cond)
    return out


def contains_any(text, words: Iterable[str]) -> Column:
    """Lower-cased substring test against a word list; NULL text gives False."""
    low = F.lower(_col(text))
    out = F.lit(False)
    for w in words:
        out = out | low.contains(w)
    return F.coalesce(out, F.lit(False))


def foreign_language(text, keywords: Iterable[str] | None = None) -> Column:
    """P5 predicate: True when the lowered text contains a foreign keyword."""
    return contains_any(text, fixed.FOREIGN_KEYWORDS if keywords is None else keywords)


def concentrate_flag(category, name, words: Iterable[str] | None = None,
                     concentrate_category: str = fixed.CONCENTRATE_CATEGORY) -> Column:
    """Category is Soup and the lowered name contains a concentrate word."""
    words = fixed.CONCENTRATE_WORDS if words is None else words
    return F.coalesce(_col(category) == concentrate_category, F.lit(False)) & contains_any(name, words)


def gluten_free_flag(name, text) -> Column:
    """our own rule (the flag is consumed but never defined upstream)."""
    pat = r"(?i)gluten[- ]free"
    return F.coalesce(_col(name).rlike(pat), F.lit(False)) | F.coalesce(_col(text).rlike(pat), F.lit(False))


def name_search(col, term: str, literal: bool = False) -> Column:
    """Lowered contains; regex semantics unless ``literal``; NULL gives False."""
    low = F.lower(_col(col))
    cond = low.contains(term.lower()) if literal else low.rlike(term.lower())
    return F.coalesce(cond, F.lit(False))


def category_root(categories) -> Column:
    """F16: text before the first '>' trimmed; '' for NULL/''."""
    c = _col(categories)
    return F.when(c.isNull() | (c == ""), F.lit("")).otherwise(
        unicode_trim(F.split(c, ">").getItem(0)))
