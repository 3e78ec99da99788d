"""Sharding by a k-d tree over document metadata (operator 2).

A node that must fill k shards is cut in two along its widest metadata
dimension, at the weighted median (for odd k at the quantile k//2 of k), until
every leaf fills one shard.  The number of leaves follows from the target
bytes.  Everything is DataFrame work: the median of all nodes of a level is
found together by histograms of 1,024 buckets that are refined inside the
bucket of the median, so a pass shuffles no more than 1,024 sums per node and
task.  The driver holds one row per open node, never one per document.

Equal texts share a place in every dimension and so stay in one shard, as long
as the group alone does not outweigh ``whole_share`` of a shard; larger groups
are dealt out row by row, for else the sizes could not be near equal.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larder.llm.common import stored

BUCKETS = 1024
#: A cut is near enough when the bucket that holds the median weighs less than this share of a shard.
TOLERANCE = 0.002
WHOLE_SHARE = 0.05
#: Rows of a shard that are numbered by one task.
SLOT_ROWS = 20_000
#: A place in a dimension: 31 bits of the value, then 31 bits of a hash that orders ties.
LOW_BITS = 31


def _coordinate(column: Column, kind: str) -> Column:
    """A value's place along its dimension, 31 bits; null counts as 0 or empty.
    Numbers keep their order, labels stand where their hash puts them."""
    if kind == "number":
        return F.least(F.greatest(F.coalesce(column.cast("long"), F.lit(0)), F.lit(0)), F.lit(2**31 - 1)).cast("long")
    return F.shiftright(F.crc32(F.coalesce(column.cast("string"), F.lit(""))), 1)


def _values(spark, rows: list[tuple], names: str) -> DataFrame:
    return spark.sql("select * from values " + ", ".join(str(tuple(r)) for r in rows) + f" as t({names})")


def _place(dims: int) -> Column:
    return F.element_at(F.array(*[F.col(f"p{n}") for n in range(dims)]), F.col("dim") + 1)


def _cuts(points: DataFrame, nodes: list[dict], dims: int, unit: float) -> None:
    """Finds each node's ``cut``: rows with a smaller place go left."""
    spark, open_ = points.sparkSession, nodes
    while open_:
        ranges = _values(spark, [(n["node"], n["dim"], n["low"], n["high"], n["step"], n["goal"] - n["below"])
                                 for n in open_], "node, dim, low, high, step, goal")
        counted = (points.join(ranges, "node").withColumn("at", _place(dims))
                   .filter("at >= low and at < high")
                   .groupBy("node", "goal", F.expr("(at - low) div step").alias("bucket")).agg(F.sum("size").alias("w")))
        upto = F.sum("w").over(Window.partitionBy("node").orderBy("bucket"))
        last = F.max("bucket").over(Window.partitionBy("node"))
        found = (counted.withColumn("upto", upto).withColumn("last", last)
                 .filter("upto - w <= goal and (upto > goal or bucket = last)")
                 .groupBy("node").agg(F.min(F.struct("bucket", "w", "upto")).alias("b")))
        hits = {r.node: r.b for r in found.collect()}
        later = []
        for n in open_:
            b = hits.get(n["node"])
            if b is None:  # no row below it
                n["cut"] = n["low"]
                continue
            low = n["low"] + b.bucket * n["step"]
            high = min(low + n["step"], n["high"])
            before, after = n["below"] + b.upto - b.w, n["below"] + b.upto
            if b.w <= TOLERANCE * unit or high - low <= 1:
                n["cut"] = low if n["goal"] - before <= after - n["goal"] else high
            else:
                n |= {"low": low, "high": high, "below": before, "step": math.ceil((high - low) / BUCKETS)}
                later.append(n)
        open_ = later


def kd_leaves(points: DataFrame, dims: int, shards: int) -> DataFrame:
    """``points`` has a weight ``size``, ``node`` 0 and places p0, p1, ...; adds ``shard``."""
    spark = points.sparkSession
    spread = [f for d in range(dims) for f in (F.min(f"p{d}").alias(f"lo{d}"), F.max(f"p{d}").alias(f"hi{d}"))]
    span: list[int] = []
    room = {0: (0, shards)}  # node: its first shard, and how many it fills
    level, done = 0, {}
    while room:
        stats = points.groupBy("node").agg(F.sum("size").alias("w"), *spread).collect()
        nodes, unit = [], 0.0
        for r in (r for r in stats if r.node in room):
            first, k = room[r.node]
            if not span:
                span = [max(r[f"hi{d}"] - r[f"lo{d}"], 1) for d in range(dims)]
            widest = max(range(dims), key=lambda d: ((r[f"hi{d}"] - r[f"lo{d}"]) / span[d], -d))
            low, high = r[f"lo{widest}"], r[f"hi{widest}"] + 1
            nodes.append({"node": r.node, "dim": widest, "low": low, "high": high, "below": 0, "first": first, "k": k,
                          "step": math.ceil((high - low) / BUCKETS), "goal": int(r.w) * (k // 2) // k})
            unit = max(unit, r.w / k)
        _cuts(points, [n for n in nodes if n["k"] > 1], dims, unit)
        room, moves = {}, []
        for n in nodes:
            if n["k"] == 1:
                done[n["node"]] = n["first"]
                continue
            half = n["k"] // 2
            left, right = 2 * n["node"] + 1, 2 * n["node"] + 2
            room |= {left: (n["first"], half), right: (n["first"] + half, n["k"] - half)}
            moves.append((n["node"], n["dim"], n["cut"], left, right))
        if moves:
            steps = _values(spark, moves, "node, dim, cut, l, r")
            going = F.when(_place(dims) < F.col("cut"), F.col("l")).otherwise(F.col("r"))
            points = (points.join(steps, "node", "left").withColumn("node", F.coalesce(going, "node").cast("long"))
                      .drop("dim", "cut", "l", "r"))
            level += 1
            points = stored(points, "kd-level") if level % 4 == 0 else points
    if not done:
        return points.withColumn("shard", F.lit(0)).drop("node")
    names = _values(spark, list(done.items()), "node, shard")
    return points.join(names, "node").withColumn("shard", F.col("shard").cast("int")).drop("node")


def _numbered(rows: DataFrame, n_rows: int) -> DataFrame:
    """Slots without gaps in each shard; a shard is numbered by many tasks."""
    lanes = max(1, math.ceil(n_rows / SLOT_ROWS))
    rows = rows.withColumn("lane", F.pmod(F.xxhash64("doc_id", "tie"), F.lit(lanes)))
    ends = rows.groupBy("shard", "lane").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("shard").orderBy("lane"))
    starts = ends.select("shard", "lane", (upto - F.col("n")).alias("start"))  # one row per SLOT_ROWS rows
    own = F.row_number().over(Window.partitionBy("shard", "lane").orderBy("doc_id", "tie"))
    return (rows.withColumn("own", own).join(starts, ["shard", "lane"])
            .withColumn("slot", (F.col("start") + F.col("own") - 1).cast("long")))


def kd_shards(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              dimensions: tuple[tuple[str, str], ...] = (("source", "label"), ("lang", "label"), ("n_chars", "number")),
              shards: int | None = None, target_bytes: int | None = None,
              whole_share: float = WHOLE_SHARE) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    A row weighs its text's UTF-8 bytes plus 1; a null text has none, and it
    counts as equal to an empty one.  Give ``shards``, or ``target_bytes`` of
    a leaf.  Null metadata counts as 0 or empty, a null or repeated identifier
    is placed like any other row, and a text longer than a shard makes that
    shard larger.  An empty table gives an empty result."""
    if (shards is None) == (target_bytes is None):
        raise ValueError("give shards or target_bytes")
    text = F.coalesce(F.col(text_col), F.lit(""))
    dims = len(dimensions)
    base = stored(df.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("same"),
        *[_coordinate(F.col(c), kind).alias(f"c{n}") for n, (c, kind) in enumerate(dimensions)]), "kd-base")
    total = base.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("w")).first()
    if shards is None:
        shards = max(1, math.ceil(total.w / target_bytes))
    lead = F.min(F.struct("doc_id", *[f"c{n}" for n in range(dims)])).alias("lead")
    groups = stored(base.groupBy("same", "text_crc32", "size").agg(F.count("*").alias("copies"), lead)
                    .filter((F.col("copies") > 1) & (F.col("copies") * F.col("size") <= whole_share * total.w / shards))
                    .select("same", "text_crc32", "size", "lead"), "kd-groups")
    whole = F.col("lead").isNotNull()
    tie = F.when(whole, F.xxhash64("same")).otherwise(F.xxhash64("same", "doc_id"))
    low = F.col("tie").bitwiseAND(F.lit(2**LOW_BITS - 1))
    places = [(F.shiftleft(F.when(whole, F.col(f"lead.c{n}")).otherwise(F.col(f"c{n}")), LOW_BITS) + low).alias(f"p{n}")
              for n in range(dims)]
    points = stored(base.join(groups, ["same", "text_crc32", "size"], "left").withColumn("tie", tie)
                    .select("doc_id", "size", "text_crc32", "tie", F.lit(0).cast("long").alias("node"), *places), "kd-points")
    placed = stored(kd_leaves(points, dims, shards).select("doc_id", "size", "text_crc32", "tie", "shard"), "kd-placed")
    return _numbered(placed, total.n).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
