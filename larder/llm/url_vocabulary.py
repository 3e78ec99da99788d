"""URL filter with a weighted vocabulary (operator 10).

One Aho-Corasick automaton finds every term of the vocabulary in the
lower-cased URL in a single pass.  A hit counts only between boundaries (the
characters next to it are not a-z or 0-9), and each term counts once per URL.
A strict term rejects alone; soft terms reject when their weights add up to
the threshold, to which no shipped soft term comes alone.  Host and path rules come first: the longest fitting rule wins.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import LOWER, UPPER

#: Term, language and weight of the shipped vocabulary, one term a line.
TERMS = Path(__file__).with_name("url_terms.tsv")
#: Soft weights are 1 (weak sign), 2 or 3 (strong), so no soft term rejects alone.
THRESHOLD = 4


@dataclass(frozen=True)
class Vocabulary:
    """Lower-case terms; a soft term's weight is a positive whole number."""

    strict: tuple[str, ...]
    soft: dict[str, int]
    threshold: int = THRESHOLD

    def __post_init__(self):
        for term in (*self.strict, *self.soft):
            if not term or term != term.translate(str.maketrans(UPPER, LOWER)):
                raise ValueError(f"terms are lower-case and not empty: {term!r}")
        if any(type(w) is not int or w < 1 for w in self.soft.values()):
            raise ValueError("weights are positive whole numbers")

    @classmethod
    def read(cls, path: str | Path = TERMS, languages: Iterable[str] | None = None, threshold: int = THRESHOLD) -> Vocabulary:
        """A vocabulary from a file of ``term <tab> language <tab> weight``
        lines, where the weight of a strict term is ``strict`` and ``#``
        begins a comment; of the given ``languages`` only, or of all.  A term
        given twice has its greatest weight; strict is greater than any."""
        strict, soft = set(), {}
        wanted = None if languages is None else set(languages)
        for line in Path(path).read_text(encoding="utf-8").splitlines():
            if not line.strip() or line.startswith("#"):
                continue
            term, language, weight = line.split("\t")
            if wanted is not None and language not in wanted:
                continue
            if weight == "strict":
                strict.add(term)
            else:
                soft[term] = max(int(weight), soft.get(term, 0))
        return cls(tuple(sorted(strict)), {t: w for t, w in sorted(soft.items()) if t not in strict}, threshold)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased.  Path: from there up to ``?``, ``#`` or the end.  Both are
    empty for a null URL and for one without ``://``."""
    at = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(at, r"://([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(at, r"://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls.

    A rule is written host/path; it fits its host and all subdomains where
    the URL's path starts with the rule's path."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verb, text in sorted(rules, key=lambda r: len(r[1])):
        own, slash, rest = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(verb)).otherwise(verdict)
    return rule, verdict


def _counter(vocabulary: Vocabulary, name: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        terms = ahocorasick.Automaton()
        for term in {*vocabulary.strict, *vocabulary.soft}:
            terms.add_word(term, term)
        terms.make_automaton()
        strict = set(vocabulary.strict)
        inside = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
        for batch in batches:
            hard, soft, weight = [], [], []
            for url in batch.column(name).to_pylist():
                found = set()
                if url:
                    end = len(url) - 1
                    for last, term in terms.iter(url):
                        first = last - len(term) + 1
                        if (first == 0 or url[first - 1] not in inside) and (last == end or url[last + 1] not in inside):
                            found.add(term)
                loose = found - strict
                hard.append(len(found) - len(loose))
                soft.append(len(loose))
                weight.append(sum(vocabulary.soft[t] for t in loose))
            kept = [batch.column(c) for c in batch.schema.names if c != name]
            yield pa.RecordBatch.from_arrays(
                [*kept, *(pa.array(x, pa.int32()) for x in (hard, soft, weight))],
                names=[*(c for c in batch.schema.names if c != name), "strict_hits", "soft_hits", "soft_weight"])
    return count


def judge_urls(df: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: list[tuple[str, str]] = (),
               vocabulary: Vocabulary | None = None) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict and the hit counts.

    A null or empty URL, and one without ``://``, has an empty host and path;
    no rule fits it, and its verdict follows from the terms found (none in a
    null URL, so it is allowed).  Repeated rows are judged alike, an empty
    table gives an empty result, and a URL of any length is read whole, once.
    Without ``vocabulary``, the shipped one is used."""
    vocabulary = vocabulary or Vocabulary.read()
    host, path = host_and_path(F.col(url_col))
    text = F.translate(F.coalesce(F.col(url_col), F.lit("")), UPPER, LOWER)
    given = df.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), text.alias("url_"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in given.schema if f.name != "url_")
    counted = given.mapInArrow(_counter(vocabulary, "url_"), f"{fields}, strict_hits int, soft_hits int, soft_weight int")
    rule, ruled = longest_rule(F.col("host"), F.col("path"), list(rules))
    found = F.when((F.col("strict_hits") > 0) | (F.col("soft_weight") >= vocabulary.threshold), "block").otherwise("allow")
    return counted.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(ruled, found).alias("verdict"),
                          "strict_hits", "soft_hits", "soft_weight")


def oracle(rules: list[tuple[str, str]], vocabulary: Vocabulary, relation: str = "pages") -> str:
    """The same judgement in DuckDB SQL."""
    lowered = f"translate(coalesce(url, ''), '{UPPER}', '{LOWER}')"
    hit = lambda term: f"cast(regexp_matches(u, '(^|[^a-z0-9]){re.escape(term)}([^a-z0-9]|$)') as integer)"
    loose = [t for t in vocabulary.soft if t not in vocabulary.strict]
    fits, verbs = [], []
    for verb, text in sorted(rules, key=lambda r: -len(r[1])):
        own, slash, rest = text.partition("/")
        when = f"when (host = '{own}' or ends_with(host, '.{own}')) and starts_with(path, '{slash}{rest}') then "
        fits.append(f"{when}'{text}'")
        verbs.append(f"{when}'{verb}'")
    case = lambda arms: f"case {' '.join(arms)} end" if arms else "cast(null as varchar)"
    total = lambda parts: " + ".join(parts) or "0"
    return f"""
with cut as (select page_id, {lowered} as u,
   translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{UPPER}', '{LOWER}') as host,
   regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) as path from {relation}),
found as (select *, cast({total([hit(t) for t in vocabulary.strict])} as integer) as strict_hits,
   cast({total([hit(t) for t in loose])} as integer) as soft_hits,
   cast({total([f'{vocabulary.soft[t]} * {hit(t)}' for t in loose])} as integer) as soft_weight from cut)
select page_id, host, path, {case(fits)} as rule,
   coalesce({case(verbs)}, case when strict_hits > 0 or soft_weight >= {vocabulary.threshold} then 'block' else 'allow' end)
     as verdict, strict_hits, soft_hits, soft_weight from found
"""
