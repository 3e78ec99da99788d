"""How filters interact, over every order of applying them (operator 12).

A document is described by its mask, one bit per filter that it fails.  What
happens to it at each step of each order follows from the mask alone, so the
mask stands for one big integer: a field of ``FIELD`` bits for each of the 600
pairs of order and step and each kind of outcome, 1 where that outcome occurs.
Adding the integers of a part's documents counts all outcomes at once.  A field
holds counts up to 2**64 - 1, more than Spark can count rows, so no field ever
flows over into its neighbour.

A task sums its rows per part; the sums of tasks are added in two levels, and
only then unpacked to one row per part, order and step.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import stored

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = len(ORDERS) * len(FILTERS)
KINDS = ("kept", "removed", "redundant", "good_lost", "toxic_lost")
#: Bits of a field.
FIELD = 64
FIELDS = STEPS * len(KINDS) + len(FILTERS)
GOOD, TOXIC = 1 << len(FILTERS), 2 << len(FILTERS)
#: Sums of one part that are added in one go, and parts that a task sums before it hands them on.
FANIN, HELD_PARTS = 256, 256

_CAPITALS = bytes(range(65, 91))
_CONTINUED = bytes(range(0x80, 0xC0))
_MARKS = b"#$%&*|"

RESULT = "part string, filter_order string, step int, " + ", ".join(
    f"{c} long" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))


def text_mask(text: bytes) -> int:
    """Bits of the filters A to D that a text, in UTF-8, fails: under 200
    words; distinct words under half of all; capitals A-Z over 3 % of the code
    points; any of ``#$%&*|``.  ``bytes.split`` cuts at the six white-space
    bytes 0x09-0x0D and 0x20, and at no others."""
    words = text.split()
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = len(text.translate(None, _CONTINUED))
    failed = (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * capitals > 3 * points,
              len(text.translate(None, _MARKS)) < len(text))
    return sum(bit << n for n, bit in enumerate(failed))


@lru_cache(maxsize=256)
def packed(code: int) -> int:
    """The big integer of one document: ``code`` is its mask, plus ``GOOD``
    and ``TOXIC`` where they hold."""
    fields = np.zeros(FIELDS, dtype="<u8")
    by_kind = fields[:STEPS * len(KINDS)].reshape(len(KINDS), len(ORDERS), len(FILTERS))
    for o, order in enumerate(ORDERS):
        there = True
        for s, name in enumerate(order):
            fails = bool(code >> FILTERS.index(name) & 1)
            removed = there and fails
            by_kind[:, o, s] = (there and not fails, removed, fails and not there,
                                removed and bool(code & GOOD), removed and bool(code & TOXIC))
            there = there and not fails
    for n in range(len(FILTERS)):
        fields[STEPS * len(KINDS) + n] = code & (GOOD - 1) == 1 << n
    return int.from_bytes(fields.tobytes(), "little")


def to_bytes(total: int) -> bytes:
    return total.to_bytes(FIELDS * FIELD // 8, "little")


def unpack(total: int) -> tuple[np.ndarray, np.ndarray]:
    """(kinds x orders x steps counts, counts of documents that fail one filter only)."""
    fields = np.frombuffer(to_bytes(total), dtype="<u8").astype(np.int64)
    return (fields[:STEPS * len(KINDS)].reshape(len(KINDS), len(ORDERS), len(FILTERS)), fields[STEPS * len(KINDS):])


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        masks, digests = [], []
        for value in batch.column("body"):
            text = value.as_py()
            masks.append(text_mask(text))
            digests.append(hashlib.sha256(text).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())],
            names=["doc_id", "part", "mask", "digest"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One big integer per part of the task's rows (part, code, n)."""
    context = TaskContext.get()
    salt = context.partitionId() % FANIN if context else 0

    def handed(totals: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.string()), pa.array([salt] * len(totals), pa.int32()),
             pa.array([to_bytes(t) for t in totals.values()], pa.binary())], names=["part", "salt", "total"])

    totals: dict[str, int] = {}
    for batch in batches:
        counts: Counter = Counter()
        for part, code, n in zip(*(batch.column(c).to_pylist() for c in ("part", "code", "n")), strict=True):
            counts[part, code] += n
        for (part, code), n in counts.items():
            totals[part] = totals.get(part, 0) + n * packed(code)
            if len(totals) >= HELD_PARTS:
                yield handed(totals)
                totals = {}
    if totals:
        yield handed(totals)


def _added(totals) -> int:
    return sum(int.from_bytes(t, "little") for t in totals)


def _some_added(key, rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"part": [key[0]], "total": [to_bytes(_added(rows["total"]))]})


def _all_added(key, rows: pd.DataFrame) -> pd.DataFrame:
    by_kind, unique = unpack(_added(rows["total"]))
    shapley = {name: sum(int(by_kind[1, o, order.index(name)]) for o, order in enumerate(ORDERS)) for name in FILTERS}
    out = []
    for o, order in enumerate(ORDERS):
        for s, name in enumerate(order):
            kept, removed, redundant, good, toxic = (int(v) for v in by_kind[:, o, s])
            out.append((key[0], order, s + 1, kept, removed, redundant, int(unique[FILTERS.index(name)]), good, toxic, shapley[name]))
    return pd.DataFrame(out, columns=[c.split()[0] for c in RESULT.split(", ")])


def outcomes(coded: DataFrame) -> DataFrame:
    """The audit of (part, code, n): ``n`` documents of a part with a code."""
    sums = coded.mapInArrow(_summed, "part string, salt int, total binary")
    some = sums.groupBy("part", "salt").applyInPandas(_some_added, "part string, total binary")
    return some.groupBy("part").applyInPandas(_all_added, RESULT)


def audit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per part, order of the five filters and step, see ``RESULT``.

    Filters A to D are those of ``text_mask``; E fails a document whose text
    is identical to that of a smaller identifier, anywhere in the table.  Null
    texts and parts count as empty, whatever the text's length it is read
    whole.  A null identifier is smaller than none and has none below it;
    rows that repeat an identifier are documents of their own, and do not fail
    E on each other's account.  ``labels`` (doc_id, quality, toxic) may lack documents (neither good
    nor toxic) or repeat them (1 in any row counts).  Other columns are not
    looked at.  No document, no part, no row."""
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                     F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body"))
    facts = stored(docs.mapInArrow(_facts, "doc_id long, part string, mask int, digest binary"), "audit-facts")
    # Repeated rows are counted once; what is joined below has no key that many rows share.
    rows = facts.groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n"))
    first = facts.filter("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    known = rows.filter("doc_id is not null").join(first, ["digest", "doc_id"], "left").join(marks, "doc_id", "left").select(
        "part", "n", (F.col("mask") + F.when(F.col("first").isNull(), 1 << FILTERS.index("E")).otherwise(0)
                      + F.coalesce("good", F.lit(0)) * GOOD + F.coalesce("toxic", F.lit(0)) * TOXIC).alias("code"))
    unnamed = rows.filter("doc_id is null").select("part", "n", F.col("mask").alias("code"))
    return outcomes(known.unionByName(unnamed))


ORACLE = """
with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as body from documents),
w as (select *, regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+') as words, min(doc_id) over (partition by body) as first from d),
l as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
m as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
    (len(words) < 200)::int + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::int
    + 4 * (100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 3 * length(body))::int
    + 8 * regexp_matches(body, '[#$%&*|]')::int + 16 * coalesce(doc_id > first, false)::int as mask
  from w left join l using (doc_id)),
c as (select part, mask, good, toxic, count(*) as n from m group by all),
f as (select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) t(name, bit)),
o as (
  select a.name || b.name || c.name || d.name || e.name as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
  from f a, f b, f c, f d, f e where a.bit + b.bit + c.bit + d.bit + e.bit = 31
    and len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
s as (select filter_order, step::int as step, bits[step] as bit, coalesce(list_sum(bits[1:step - 1]), 0)::int as before
  from o, range(1, 6) r(step)),
t as (
  select part, filter_order, step, bit,
    sum(n) filter (where mask & (before | bit) = 0) as kept,
    sum(n) filter (where mask & bit <> 0 and mask & before = 0) as removed,
    sum(n) filter (where mask & bit <> 0 and mask & before <> 0) as redundant,
    sum(n) filter (where mask = bit) as unique_fails,
    sum(n) filter (where mask & bit <> 0 and mask & before = 0 and good = 1) as good_lost,
    sum(n) filter (where mask & bit <> 0 and mask & before = 0 and toxic = 1) as toxic_lost
  from c, s group by all)
select part, filter_order, step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed,
  coalesce(redundant, 0)::bigint as redundant, coalesce(unique_fails, 0)::bigint as unique_fails,
  coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost,
  coalesce(sum(removed) over (partition by part, bit), 0)::bigint as shapley from t
"""
