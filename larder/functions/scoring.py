"""Additive detection and scoring Column builders.

All scores are plain Column arithmetic, so a whole catalogue is scored in one
narrow, code-generated stage.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.functions import fixed
from larder.functions.text import _col


def _text(text) -> Column:
    return F.coalesce(_col(text), F.lit(""))


def e_number_count(text) -> Column:
    """F8: number of E-number matches (case-insensitive); 0 for NULL/''."""
    return F.regexp_count(_text(text), F.lit(fixed.E_NUMBER_PATTERN))


def additive_dictionary() -> Column:
    """The concerning-additive dictionary as an array<struct> literal."""
    return F.array(*[
        F.struct(F.lit(name).alias("additive"), F.lit(desc).alias("description"))
        for name, desc in fixed.CONCERNING_ADDITIVES
    ])


def concerning_additives(text) -> Column:
    """dictionary entries whose name is a substring of the lowered text,
    in dictionary order, as array<struct<additive, description>>."""
    low = F.lower(_text(text))
    return F.filter(additive_dictionary(), lambda x: low.contains(x["additive"]))


def additive_names(additives: Column, sep: str = "; ") -> Column:
    return F.array_join(F.transform(additives, lambda x: x["additive"]), sep)


def nova_points(nova, numeric: bool = False) -> Column:
    """NOVA component of F10, following Python truthiness on the raw value.

    Text NOVA: anything that does not parse as an integer scores the unknown
    points ('' / NULL / 'unknown' / '4.0'); '0' parses and scores -13.
    Numeric NOVA: NULL, NaN and 0 are falsy and score the unknown points.
    """
    n = _col(nova)
    if numeric:
        as_int = n.cast("double").try_cast("int")
        unknown = n.isNull() | F.isnan(n.cast("double")) | (n.cast("double") == 0) | as_int.isNull()
    else:
        as_int = n.cast("string").try_cast("int")
        unknown = as_int.isNull()
    return F.when(unknown, F.lit(fixed.NOVA_UNKNOWN_POINTS)).otherwise(
        (as_int - 1) * fixed.NOVA_STEP_POINTS)


def processing_score(nova, text, numeric_nova: bool = False) -> Column:
    """NOVA points + min(5*E, 30) + min(6*additives, 30), capped at 100."""
    return score_of_counts(nova, e_number_count(text), F.size(concerning_additives(text)), numeric_nova)


def score_of_counts(nova, e_numbers: Column, n_additives: Column, numeric_nova: bool = False) -> Column:
    """F10 from counts that are already columns, without reading the text again."""
    total = (nova_points(nova, numeric_nova)
             + F.least(e_numbers * fixed.E_NUMBER_POINTS, F.lit(fixed.E_NUMBER_CAP))
             + F.least(n_additives * fixed.ADDITIVE_POINTS, F.lit(fixed.ADDITIVE_CAP)))
    return F.least(total, F.lit(fixed.SCORE_CAP))


def nova_int(nova) -> Column:
    """Integer NOVA as Python ``int(x)`` would parse text; NULL otherwise."""
    return _col(nova).cast("string").try_cast("int")


def nova_label(nova) -> Column:
    """F11."""
    n = nova_int(nova)
    out = None
    for k, label in fixed.NOVA_LABELS.items():
        out = F.when(n == k, F.lit(label)) if out is None else out.when(n == k, F.lit(label))
    return out.otherwise(F.lit(fixed.NOVA_UNKNOWN_LABEL))


def _badge_part(score, idx: int) -> Column:
    s = _col(score)
    out = None
    for bound, emoji, label in fixed.PROCESSING_BADGES:
        val = F.lit(emoji if idx == 0 else label)
        if bound is None:
            return out.otherwise(val)
        out = F.when(s <= bound, val) if out is None else out.when(s <= bound, val)
    return out


def processing_badge(score) -> Column:
    """F12 emoji."""
    return _badge_part(score, 0)


def processing_label(score) -> Column:
    """F12 label."""
    return _badge_part(score, 1)


def suggestions(text, e_count: Column, additives: Column) -> Column:
    """improvement suggestions, in rule order, as array<string>."""
    low_text = F.lower(_text(text))
    has_desc = lambda word: F.exists(additives, lambda x: F.lower(x["description"]).contains(word))
    return F.array_compact(F.array(
        F.when(e_count > 3, F.format_string(fixed.SUGGESTION_E_NUMBERS.replace("{n}", "%d"), e_count)),
        F.when(has_desc("sweetener"), F.lit(fixed.SUGGESTION_SWEETENER)),
        F.when(has_desc("colour"), F.lit(fixed.SUGGESTION_COLOUR)),
        F.when(low_text.contains("palm oil"), F.lit(fixed.SUGGESTION_PALM_OIL)),
    ))


def why_ultra_processed(additives: Column, n: int = 3) -> Column:
    """P19 text: first ``n`` additives as 'Name: description', or the default."""
    items = F.transform(F.slice(additives, 1, n),
                        lambda x: F.concat(F.initcap(x["additive"]), F.lit(": "), x["description"]))
    return F.when(F.size(additives) > 0, F.array_join(items, "; ")).otherwise(F.lit(fixed.WHY_UPF_DEFAULT))


def healthiness_score(ingredient_count, nova, e_count, additive_count) -> Column:
    """F15 on the 0-100 scale.

    0.40*min(cnt/20,1)*100 + 0.30*(nova-1)/3*100 + 0.20*min(E/10,1)*100
    + 0.10*min(add/5,1)*100 reduces exactly to
    2*min(cnt,20) + 10*(nova-1) + 2*min(E,10) + 2*min(add,5); the integer form is
    what the rounded (2 dp) float equals, and it sorts and ties exactly.
    Missing ingredient count defaults to 20, missing NOVA to 4.
    """
    cnt = F.coalesce(_col(ingredient_count), F.lit(fixed.HEALTH_DEFAULT_INGREDIENTS))
    nv = F.coalesce(nova_int(nova), F.lit(fixed.HEALTH_DEFAULT_NOVA))
    score = (2 * F.least(cnt, F.lit(fixed.HEALTH_INGREDIENT_CAP))
             + 10 * (nv - 1)
             + 2 * F.least(_col(e_count), F.lit(fixed.HEALTH_E_NUMBER_CAP))
             + 2 * F.least(_col(additive_count), F.lit(fixed.HEALTH_ADDITIVE_CAP)))
    return score.cast("double")


def explanation(t_cnt, a_cnt, t_nova, a_nova, t_e, a_e) -> Column:
    """F16 ``generate_explanation``: reasons joined by ' | ', or the default."""
    reasons = F.array_compact(F.array(
        F.when(a_cnt < t_cnt, F.format_string("%d fewer ingredients", t_cnt - a_cnt)),
        F.when(a_nova < t_nova, F.format_string("Less processed (NOVA %d vs %d)", a_nova, t_nova)),
        F.when(a_e < t_e, F.format_string("%d fewer E-numbers", t_e - a_e)),
    ))
    return F.when(F.size(reasons) > 0, F.array_join(reasons, " | ")).otherwise(F.lit(fixed.EXPLANATION_DEFAULT))


def to_number(c) -> Column:
    """``to_numeric(errors='coerce').fillna(0)``: unparsable, NULL and NaN -> 0."""
    d = _col(c).cast("string").try_cast("double")
    return F.coalesce(F.nanvl(d, F.lit(0.0)), F.lit(0.0))


def falsy_to_zero(c) -> Column:
    """``float(x) if x else 0.0``."""
    d = _col(c).cast("string").try_cast("double")
    return F.coalesce(d, F.lit(0.0))
