"""Periodic runs of words, found on a grammar (operator 11).

The texts of a slice are one sequence of word ids with a mark of its own after
each text.  Re-Pair turns it into a grammar: in every round the most frequent
pairs become nonterminals, many at once where their occurrences do not
overlap, until no pair occurs twice.  What is left of a text is put under a
balanced tree of nonterminals that occur once.

A run lies in a lowest nonterminal that holds all of it, and crosses the
boundary between that one's two halves.  So the runs across each nonterminal's
boundary are computed once, on one of its occurrences, however often it
occurs; then they are translated to all positions that derive from it.  A run
that is cut off by the end of a nonterminal is part of one found higher up:
overlapping intervals of one period are merged, and what remains is maximal.

A run of period q with at least four periods holds two whole ones on one side
of the boundary, so the pair of words around the boundary occurs again q words
away.  Only such q are tried; prefix hashes tell how far the period reaches,
and each interval that is found is compared word by word.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST, PERIODS = 6, 4
#: Words of a slice of texts; a longer text is a slice of its own.
SLICE_WORDS = 300_000
#: Candidates that are looked at together.
CHUNK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)

SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, kept_words long, collapsed_sha256 string"


@dataclass
class Grammar:
    """``first``: a text position of each nonterminal, ``half`` and ``size``:
    words of its left half and of all of it; ``rule`` and ``at``: every
    occurrence as (nonterminal, text position)."""

    first: np.ndarray
    half: np.ndarray
    size: np.ndarray
    rule: np.ndarray
    at: np.ndarray


def _halved(same: np.ndarray) -> np.ndarray:
    """Every second member of each stretch of consecutive indices ``same``."""
    starts = np.ones(len(same), dtype=bool)
    starts[1:] = np.diff(same) != 1
    begin = np.maximum.accumulate(np.where(starts, np.arange(len(same)), 0))
    return (np.arange(len(same)) - begin) % 2 == 0


def re_pair(ids: np.ndarray, ends: np.ndarray) -> Grammar:
    """The grammar of the texts that end before the positions ``ends``."""
    n = len(ids)
    text = np.searchsorted(ends, np.arange(n), side="right")
    symbol, at, owner = ids.astype(np.int64), np.arange(n), text
    size = np.ones(n, dtype=np.int64)
    fresh = int(ids.max()) + 1 if n else 0
    # may[i]: the pair at i may occur twice.  A pair of old symbols only gets rarer, so once it is alone it stays so.
    may = np.zeros(n, dtype=bool)
    may[:-1] = owner[1:] == owner[:-1]
    found: list[tuple[np.ndarray, ...]] = []  # per round: first, half, size, rule, at
    rules = 0
    while True:
        here = np.flatnonzero(may)
        if not len(here):
            break
        key = symbol[here] * fresh + symbol[here + 1]
        # Of a stretch of one symbol, every second pair counts.
        counted = np.ones(len(here), dtype=bool)
        alike = np.flatnonzero(symbol[here] == symbol[here + 1])
        counted[alike] = _halved(here[alike])
        order = np.argsort(key)
        ordered = key[order]
        edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        group = np.empty(len(here), dtype=np.int64)
        group[order] = np.repeat(np.arange(len(edge)), np.diff(np.concatenate([edge, [len(here)]])))
        times = np.bincount(group, weights=counted, minlength=len(edge)).astype(np.int64)
        alone = times[group] < 2
        may[here[alone]] = False
        here, group, counted = here[~alone], group[~alone], counted[~alone]
        if not len(here):
            break
        # The more frequent pair goes first, among equals the one with the smaller number.
        rank = np.empty(len(edge), dtype=np.int64)
        rank[np.lexsort((np.arange(len(edge)), -times))] = np.arange(len(edge))
        place = rank[group][counted]
        here, group = here[counted], group[counted]
        best = np.full(len(symbol) + 2, np.iinfo(np.int64).max)
        best[here + 1] = place
        chosen = (best[here] > place) & (best[here + 2] > place)
        many = np.bincount(group[chosen], minlength=len(edge))
        chosen &= many[group] >= 2
        here, group = here[chosen], group[chosen]
        # The most frequent pair of all is chosen wherever it counts, so every round replaces something.
        used, first, number = np.unique(group, return_index=True, return_inverse=True)
        half, whole = size[here], size[here] + size[here + 1]
        found.append((at[here][first], half[first], whole[first], rules + number, at[here]))
        symbol[here] = fresh + number
        size[here] = whole
        keep = np.ones(len(symbol), dtype=bool)
        keep[here + 1] = False
        may[here] = True
        may[here[here > 0] - 1] = True  # the pair before a new symbol is new, too
        symbol, at, size, owner, may = symbol[keep], at[keep], size[keep], owner[keep], may[keep]
        may[-1] = False
        may[:-1] &= owner[1:] == owner[:-1]
        rules += len(used)
        fresh += len(used)
    while True:  # what is left of a text goes two by two under a tree
        cut = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.empty(0, dtype=np.int64)
        inside = np.arange(len(owner)) - np.repeat(cut, np.diff(np.concatenate([cut, [len(owner)]])))
        left = np.flatnonzero((inside[:-1] % 2 == 0) & (owner[1:] == owner[:-1])) if len(owner) > 1 else np.empty(0, dtype=np.int64)
        if not len(left):
            break
        whole = size[left] + size[left + 1]
        found.append((at[left], size[left], whole, rules + np.arange(len(left)), at[left]))
        rules += len(left)
        size[left] = whole
        keep = np.ones(len(owner), dtype=bool)
        keep[left + 1] = False
        at, size, owner = at[keep], size[keep], owner[keep]
    if not found:
        return Grammar(*[np.empty(0, dtype=np.int64)] * 5)
    return Grammar(*(np.concatenate(part) for part in zip(*found, strict=True)))


class _Words:
    """Word ids with prefix hashes: how far two places agree."""

    def __init__(self, ids: np.ndarray) -> None:
        self.ids = ids
        n = len(ids)
        self.power = np.full(n + 1, _BASE, dtype=np.uint64)
        self.power[0] = 1
        self.power = np.multiply.accumulate(self.power)
        value = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        value ^= value >> np.uint64(31)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(value * self.power[:n], out=self.sums[1:])

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether ``length`` words from a on equal those from b on (a < b)."""
        one = (self.sums[a + length] - self.sums[a]) * self.power[b - a]
        return one == self.sums[b + length] - self.sums[b]

    def ahead(self, a, b, most) -> np.ndarray:
        """The number of equal words from a and b (a < b) on, ``most`` at most."""
        low, high = np.zeros_like(most), most.copy()
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            fits = self.equal(a, b, middle)
            low, high = np.where(open_ & fits, middle, low), np.where(open_ & ~fits, middle - 1, high)
        return low

    def behind(self, a, b, most) -> np.ndarray:
        """The number of equal words before a and b (a < b), ``most`` at most."""
        low, high = np.zeros_like(most), most.copy()
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            fits = self.equal(a - middle, b - middle, middle)
            low, high = np.where(open_ & fits, middle, low), np.where(open_ & ~fits, middle - 1, high)
        return low

    def exact_reach(self, centre: int, q: int, low: int, high: int) -> tuple[int, int]:
        """The interval of period q within [low, high) around the equal words
        ``centre`` and ``centre + q``, word by word."""
        same = self.ids[low:high - q] == self.ids[low + q:high]
        unlike = np.flatnonzero(~same) + low
        at = np.searchsorted(unlike, centre)
        if at < len(unlike) and unlike[at] == centre:
            return centre, centre
        start = int(unlike[at - 1]) + 1 if at else low
        stop = int(unlike[at]) if at < len(unlike) else high - q
        return start, stop + q


def boundary_runs(words: _Words, first: np.ndarray, half: np.ndarray, size: np.ndarray, least: int, periods: int):
    """(nonterminal, start, stop, period) of the intervals with ``periods``
    periods and ``least`` words or more that cross each boundary, as text
    positions of the given occurrence."""
    empty = [np.empty(0, dtype=np.int64)] * 4
    ids = words.ids
    wanted = np.flatnonzero(size >= max(least, periods))
    if len(ids) < 2 or not len(wanted):
        return empty
    pair = ids[:-1] * (int(ids.max()) + 1) + ids[1:]
    order = np.argsort(pair, kind="stable")  # places of one pair in a row, ascending
    ordered = pair[order]
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    group = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    begin = np.maximum.accumulate(np.where(group, np.arange(len(order)), 0))
    last = np.concatenate([np.flatnonzero(group)[1:], [len(order)]])[np.cumsum(group) - 1]
    place = first[wanted] + half[wanted] - 1  # the pair around the boundary stands here
    reach = size[wanted] // periods
    hits = []
    for side, room in ((1, size[wanted] - half[wanted]), (-1, half[wanted])):
        most = np.minimum(reach, room // (periods // 2))
        r = rank[place]
        end = last[r] - 1 if side > 0 else begin[r]
        live = np.flatnonzero((r != end) & (most > 0))
        step = 1
        # The pair's next place, the one after it, and so on while they are near enough.
        while len(live):
            q = (order[r[live] + side * step] - place[live]) * side
            live, q = live[q <= most[live]], q[q <= most[live]]
            if not len(live):
                break
            b = place[live] + 1
            # Two whole periods on this side; the words at a and a + q agree.
            square = words.equal(b, b + q, q) if side > 0 else words.equal(b - 2 * q, b - q, q)
            hits.append((live[square], q[square], np.full(int(square.sum()), side)))
            live = live[r[live] + side * step != end[live]]
            step += 1
    hits = [h for h in hits if len(h[0])]
    if not hits:
        return empty
    node, q, side = (np.concatenate(x) for x in zip(*hits, strict=True))
    own = wanted[node]
    low, high, b = first[own], first[own] + size[own], place[node] + 1
    a = np.where(side > 0, b, b - q)
    before = words.behind(a, a + q, a - low)
    after = words.ahead(a, a + q, high - a - q)
    start, stop = a - before, a + q + after
    good = (stop - start >= np.maximum(least, periods * q)) & (start < b) & (stop > b)
    own, start, stop, q, a, low, high = (x[good] for x in (own, start, stop, q, a, low, high))
    # A multiple of a period has the same interval: the smallest one stays.
    by = np.lexsort((q, stop, start, own))
    own, start, stop, q, a, low, high = (x[by] for x in (own, start, stop, q, a, low, high))
    new = np.ones(len(own), dtype=bool)
    new[1:] = (own[1:] != own[:-1]) | (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    own, start, stop, q, a, low, high = (x[new] for x in (own, start, stop, q, a, low, high))
    keep = np.ones(len(own), dtype=bool)
    for n in range(len(own)):  # few: hashes are never trusted alone
        if not np.array_equal(ids[start[n]:stop[n] - q[n]], ids[start[n] + q[n]:stop[n]]):
            start[n], stop[n] = words.exact_reach(int(a[n]), int(q[n]), int(low[n]), int(high[n]))
            keep[n] = stop[n] - start[n] >= max(least, periods * q[n])
    return own[keep], start[keep], stop[keep], q[keep]


def merged(start: np.ndarray, stop: np.ndarray, period: np.ndarray):
    """Maximal intervals: those of one period that share a period's words or
    more are one, and equal intervals keep their smallest period."""
    by = np.lexsort((-stop, start, period))
    start, stop, period = start[by], stop[by], period[by]
    out: list[list[int]] = []
    for s, e, q in zip(start.tolist(), stop.tolist(), period.tolist(), strict=True):
        if out and out[-1][2] == q and out[-1][1] - s >= q:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e, q])
    smallest: dict[tuple[int, int], int] = {}
    for s, e, q in out:
        smallest[s, e] = min(q, smallest.get((s, e), q))
    return sorted((s, e, q) for (s, e), q in smallest.items())


def runs_of(texts: list[list], least: int = LEAST, periods: int = PERIODS) -> list[list[tuple[int, int, int]]]:
    """For each sequence of words, all maximal (start, length, smallest
    period) with ``length >= max(least, periods * period)``, sorted by start,
    then period."""
    number: dict = {}
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    ids = np.fromiter((number.setdefault(w, len(number)) for t in texts for w in t), dtype=np.int64, count=int(lengths.sum()))
    ends = np.cumsum(lengths)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if len(ids) < least:
        return out
    grammar = re_pair(ids, ends)
    own, start, stop, period = boundary_runs(_Words(ids), grammar.first, grammar.half, grammar.size, least, periods)
    if not len(own):
        return out
    # To all positions that derive from a nonterminal with runs.
    at, rule = grammar.at, grammar.rule
    used = np.isin(rule, own)
    at, rule = at[used], rule[used]
    by = np.argsort(own, kind="stable")
    own, start, stop, period = own[by], start[by] - grammar.first[own[by]], stop[by] - grammar.first[own[by]], period[by]
    low, high = np.searchsorted(own, rule), np.searchsorted(own, rule, side="right")
    times = high - low
    which = np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    base = np.repeat(at, times)
    start, stop, period = base + start[which], base + stop[which], period[which]
    text = np.searchsorted(ends, start, side="right")
    by = np.argsort(text, kind="stable")
    text, start, stop, period = text[by], start[by], stop[by], period[by]
    edge = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1], [True]]))
    for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        n = int(text[lo])
        shift = int(ends[n] - lengths[n])
        out[n] = [(s - shift, e - s, q) for s, e, q in merged(start[lo:hi], stop[lo:hi], period[lo:hi])]
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return [words[n] for n in np.flatnonzero(np.cumsum(drop[:-1]) == 0)]


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The contract's own runs: in every tenth text, by its identifier's
    hash, a stretch up to the end repeats (a null identifier changes nothing)."""
    n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a]


def _slices(batches: Iterator[pa.RecordBatch], change) -> Iterator[tuple[list, list]]:
    docs, texts, size = [], [], 0
    for batch in batches:
        for doc, body in zip(batch.column("doc_id"), batch.column("body"), strict=True):
            words = (body.as_py() or b"").split()  # at the bytes 0x09-0x0D and 0x20 only
            words = change(words, doc.as_py()) if change else words
            if texts and size + len(words) > SLICE_WORDS:
                yield docs, texts
                docs, texts, size = [], [], 0
            docs.append(doc.as_py())
            texts.append(words)
            size += len(words)
    if texts:
        yield docs, texts


def _detected(least: int, periods: int, change):
    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        struct = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for docs, texts in _slices(batches, change):
            runs = runs_of(texts, least, periods)
            left = [collapsed(t, r) for t, r in zip(texts, runs, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([[dict(zip(("start", "length", "period"), x, strict=True)) for x in r] for r in runs], struct),
                 pa.array([len(t) for t in left], pa.int64()),
                 pa.array([hashlib.sha256(b" ".join(t)).hexdigest() for t in left], pa.string())],
                names=["doc_id", "n_words", "runs", "kept_words", "collapsed_sha256"])
    return detect


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, periods: int = PERIODS,
                  change=None) -> DataFrame:
    """One row per input row, see ``SCHEMA``: all maximal runs of at least
    ``least`` words and ``periods`` periods (four at least), by start, then period,
    and the hash of the words that no run holds after its first period, joined by one space.

    Words are what stands between the white-space bytes 0x09-0x0D and 0x20.
    A null or empty text has no words and no run.  Rows are taken one by one:
    repeated ones give repeated results, ties of identifiers do not matter, a
    null one stays null, and other columns are not looked at.  An empty table
    gives an empty result.  A very long text is worked on whole, by one task,
    in memory in proportion to its words.  ``change(words, doc_id)`` may
    rewrite the words first."""
    if periods < 4 or periods % 2:
        raise ValueError("runs need an even number of periods, four or more")
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("body"))
    return docs.mapInArrow(_detected(least, periods, change), SCHEMA)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns: the greatest run and hashes of all."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"),
                                                              (-r["period"]).alias("short"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"),
                                                   F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.before")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.short")).alias("period"),
        F.expr("(1000 * best.length) div (-best.short)").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), "collapsed_sha256")
