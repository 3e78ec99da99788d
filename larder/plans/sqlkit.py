"""Building blocks for the DuckDB oracle SQL (independent re-statements of
each operator's semantics, used only to check the Spark plans)."""

from __future__ import annotations

from larder.functions import fixed
from larder.sources.tables import CATALOGUE_CTE


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def additive_values() -> str:
    rows = ", ".join(f"({i}, {_q(a)}, {_q(d)})" for i, (a, d) in enumerate(fixed.CONCERNING_ADDITIVES, 1))
    return f"additive_dict as (select * from (values {rows}) t(pos, additive, description))"


E_RE2 = fixed.E_NUMBER_PATTERN_RE2


def scored_ctes(source: str = "catalogue") -> str:
    """CTEs ``hits`` and ``scored`` over a catalogue-shaped relation."""
    return f"""
{additive_values()},
hits as (
  select c.code, count(a.pos) as n_additives,
         string_agg(a.additive, '; ' order by a.pos) as additives,
         max(case when lower(a.description) like '%sweetener%' then 1 else 0 end) as has_sweetener,
         max(case when lower(a.description) like '%colour%' then 1 else 0 end) as has_colour,
         string_agg(concat(array_to_string(list_transform(string_split(a.additive, ' '), lambda w: concat(upper(substr(w, 1, 1)), substr(w, 2))), ' '), ': ', a.description), '; ' order by a.pos)
           filter (where a.pos is not null) as additive_details
  from {source} c left join additive_dict a
    on contains(lower(coalesce(c.ingredients_text, '')), a.additive)
  group by c.code),
scored0 as (
  select c.*, cast(len(regexp_extract_all(coalesce(c.ingredients_text, ''), '{E_RE2}')) as bigint) as e_numbers,
         cast(h.n_additives as bigint) as n_additives, coalesce(h.additives, '') as additives,
         h.has_sweetener, h.has_colour, h.additive_details,
         try_cast(c.nova_group as integer) as nova_i
  from {source} c join hits h on h.code = c.code),
scored as (
  select *,
    cast(least(case when nova_i is null then 20 else (nova_i - 1) * 13 end
               + least(e_numbers * 5, 30) + least(n_additives * 6, 30), 100) as bigint) as processing_score,
    case nova_i when 1 then 'Unprocessed/Minimal' when 2 then 'Processed Culinary'
                when 3 then 'Processed' when 4 then 'Ultra-Processed' else 'Unknown' end as nova_label
  from scored0)"""


def badge_sql(score: str) -> str:
    return (f"case when {score} <= 20 then '🟢' when {score} <= 40 then '🟡' "
            f"when {score} <= 60 then '🟠' else '🔴' end")


def label_sql(score: str) -> str:
    return (f"case when {score} <= 20 then 'Minimally Processed' when {score} <= 40 then 'Lightly Processed' "
            f"when {score} <= 60 then 'Moderately Processed' else 'Highly Processed' end")


def with_catalogue(body: str, scored: bool = False) -> str:
    ctes = CATALOGUE_CTE
    if scored:
        ctes += "," + scored_ctes()
    return f"with {ctes}\n{body}"


def token_ctes(table: str, key: str, text: str, prefix: str = "t") -> str:
    """Tokeniser without look-ahead: a comma is kept inside an item iff the
    next parenthesis after it is ')'.  Yields ``{prefix}_items(key, g, item)``."""
    return f"""
{prefix}_p as (select {key} as key, unnest(string_split(coalesce({text}, ''), ',')) as piece,
                  generate_subscripts(string_split(coalesce({text}, ''), ','), 1) as k from {table}),
{prefix}_n as (select *, first_value(nullif(regexp_extract(piece, '[()]', 0), '') ignore nulls)
        over (partition by key order by k rows between 1 following and unbounded following) as nx from {prefix}_p),
{prefix}_b as (select key, k, piece, coalesce(sum(case when nx is distinct from ')' then 1 else 0 end)
        over (partition by key order by k rows between unbounded preceding and 1 preceding), 0) as g from {prefix}_n),
{prefix}_items as (select key, g, trim(string_agg(piece, ',' order by k), E' \\t\\n\\r') as item
        from {prefix}_b group by key, g having item <> '')"""


def normalise_sql(item: str, synonyms=None, prefixes=None) -> str:
    """F2 in SQL over an item expression; '' means skipped."""
    synonyms = fixed.DEFAULT_SYNONYMS if synonyms is None else synonyms
    prefixes = fixed.DEFAULT_SKIP_PREFIXES if prefixes is None else prefixes
    clean = f"replace(lower(trim({item}, E' \\t\\n\\r')), '.', '')"
    skip = " or ".join(f"starts_with({clean}, {_q(p)})" for p in prefixes)
    cases = " ".join(f"when {clean} = {_q(k)} then {_q(v)}" for k, v in synonyms.items())
    mapped = f"(case {cases} else {clean} end)"
    return f"(case when {skip} then '' when length({mapped}) > 1 then {mapped} else '' end)"


DASH_CTE = """dash as (
  select code, product_name, brand, category_searched, nova_group, ingredients_text, countries_sold,
         coalesce(sugar_100g, 0.0) as sugar_100g, coalesce(salt_100g, 0.0) as salt_100g, coalesce(fat_100g, 0.0) as fat_100g,
         (category_searched = 'Soup' and
          coalesce(regexp_matches(lower(product_name), 'stock|pot|cube|bouillon|powder|instant|dry|mix'), false))
           as is_soup_concentrate
  from catalogue
  where (countries_sold ilike '%Ireland%' or countries_sold ilike '%en:ie%') and ingredients_text <> ''
    and not coalesce(regexp_matches(lower(ingredients_text), 'zucker|wasser|spiesesalz|weizenmehl'), false))"""


def with_dash(body: str, scored: bool = False) -> str:
    """Catalogue -> dashboard load (P1/P2/P14/P5/P6) -> optional scoring."""
    ctes = CATALOGUE_CTE + ",\n" + DASH_CTE
    if scored:
        ctes += "," + scored_ctes("dash")
    return f"with {ctes}\n{body}"
