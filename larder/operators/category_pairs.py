"""Distinct in-category pairs by a keyed permutation of the pair numbers.

A category of n members has A x B pairs, with A = n and B = (n - 1) / 2 for odd
n, and A = n / 2 and B = n - 1 for even n.  A number is a place (l, r) in that
grid; rounds that add a keyed hash of one part to the other, modulo A and B,
permute all places.  So the first m numbers give m distinct pairs, with no step
that removes repetitions and no pair held in memory.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.operators.pairs import category_positions
from larder.session import cut_lineage

#: Rounds of the permutation, and numbers that one row stands for until they are dealt out.
ROUNDS, CHUNK = 3, 4_096
#: Pairs that one task draws and places.
PAIRS_PER_TASK = 500_000


def _permuted(seed: int) -> Column:
    """The place (l, r) after all rounds; a step adds to l, the next one to r.
    A fold keeps the steps out of one ever larger generated method."""
    def step(place, i):
        first = i % 2 == 0
        text = F.concat_ws("|", F.lit(str(seed)), i, F.col("cat_idx"), F.when(first, place["r"]).otherwise(place["l"]))
        keyed = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")
        moved = (F.when(first, place["l"]).otherwise(place["r"]) + keyed) % F.when(first, F.col("A")).otherwise(F.col("B"))
        return F.struct(F.when(first, moved).otherwise(place["l"]).alias("l"), F.when(first, place["r"]).otherwise(moved).alias("r"))

    start = F.struct(F.expr("pair div B").alias("l"), (F.col("pair") % F.col("B")).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(2 * ROUNDS - 1)), start, step)


def category_pairs(products: DataFrame, per_member: int | None = 10, max_pairs: int | None = None, seed: int = 42,
                   key: str = "code", category_col: str = "category_searched") -> DataFrame:
    """(category, pair, product1, product2): for each category, distinct pairs
    of different members, product1 before product2 in key order.

    ``per_member`` times its members are drawn, at most ``max_pairs`` and at
    most all; both None give every pair.  ``pair`` numbers a category's draws
    from 0.  Rows without a category are left out; a category of one member
    has no pair."""
    pos, cats = category_positions(products, key, category_col)
    pos = cut_lineage(pos)
    n = F.col("n_c")
    wanted = [n * per_member] * (per_member is not None) + [F.lit(max_pairs).cast("long")] * (max_pairs is not None)
    every = (n * (n - 1) / 2).cast("long")
    even = n % 2 == 0
    cats = cats.where(n > 1).select(
        "off", "cat_idx", F.least(every, *wanted).alias("m") if wanted else every.alias("m"),
        F.when(even, n / 2).otherwise(n).cast("long").alias("A"), F.when(even, n - 1).otherwise((n - 1) / 2).cast("long").alias("B"))
    cats = cut_lineage(cats.where("m > 0"))  # one row per category
    drawn = cats.agg(F.sum("m")).first()[0] or 0
    # A chunk is a small row that stands for many, so the number of tasks is told, not left to the rows' size.
    tasks = max(1, math.ceil(drawn / PAIRS_PER_TASK))
    chunks = cats.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1, F.lit(CHUNK).cast("long"))))
    chunks = chunks.repartition(tasks, "cat_idx", "from")
    p = chunks.withColumn("pair", F.explode(F.sequence("from", F.least(F.col("m"), F.col("from") + CHUNK) - 1)))
    p = p.withColumn("place", _permuted(seed))
    # Row i of the triangle holds the pairs (j, i) with j < i; the root is rounded, so it is put right.
    p = p.withColumn("u", F.col("place.l") * F.col("B") + F.col("place.r"))
    p = p.withColumn("i", F.floor((1 + F.sqrt(1 + 8 * F.col("u").cast("double"))) / 2).cast("long"))
    below = lambda i: F.shiftright(i * (i - 1), 1)
    p = p.withColumn("i", F.when(below(F.col("i")) > F.col("u"), F.col("i") - 1)
                     .when(below(F.col("i") + 1) <= F.col("u"), F.col("i") + 1).otherwise(F.col("i")))
    p = p.select("pair", (F.col("off") + F.col("u") - below(F.col("i"))).alias("p1"), (F.col("off") + F.col("i")).alias("p2"))
    a = pos.select(F.col("pos").alias("p1"), F.col(category_col).alias("category"), F.col(key).alias("product1"))
    b = pos.select(F.col("pos").alias("p2"), F.col(key).alias("product2"))
    # A few chunks stand for all pairs, so adaptive execution takes the pairs for a small table and would send them through the driver.
    return p.hint("merge").join(a, "p1").hint("merge").join(b, "p2").select("category", "pair", "product1", "product2")
