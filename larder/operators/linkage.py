"""Agglomerative clustering over a sparse neighbour graph.

Pairs of rows without an edge are at the distance ``far``, the largest there
is.  Clusters then have an edge where some of their rows have one, and linkages
are updated from the edges alone (Lance-Williams): single linkage takes the
least of two distances, complete linkage the greatest, and is ``far`` as soon
as one pair has no edge; average linkage sums what the edges fall short of
``far``, over all pairs of rows.

In each round every cluster finds its nearest one, and all pairs that are
nearest to each other merge at once.  These linkages are reducible: a merge
brings no other cluster nearer, so the merges are those of the greedy method,
which takes the nearest pair of all each time.  Distances tie by the clusters'
names, so there is always a pair to merge.  Where one large cluster takes in
the others one by one, as single linkage tends to, only one pair a round is
nearest to each other, and there are about as many rounds as rows in it.  A round is two aggregates and a
join over the edges, which only get fewer; nothing passes through the driver,
and all linkages asked for share the rounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.operators.components import connected_components
from larder.session import cut_lineage

LINKAGES = ("average", "complete", "single")


def dendrogram(edges: DataFrame, far: float, linkages: Sequence[str] = LINKAGES) -> DataFrame:
    """(linkage, turn, a, b, distance, size): all merges below ``far`` of the
    clusters a < b, named by their least rows, into one named a.

    ``edges`` has (a, b, distance), each pair of rows once, with distances
    under ``far``; edges from there on, loops and nulls are left out, of repeated
    pairs the least counts.  Turns number the rounds; a cluster's merges come
    in turns after those of its parts."""
    if not set(linkages) <= set(LINKAGES):
        raise ValueError(f"linkages are {', '.join(LINKAGES)}")
    each = F.explode(F.array(*[F.lit(x) for x in linkages])).alias("linkage")
    pairs = (edges.where((F.col("a") != F.col("b")) & (F.col("distance") < far))
             .groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min("distance").alias("d")))
    # na and nb: rows of the clusters; gain: what all edges between them fall short of far.
    now = cut_lineage(pairs.select(each, "a", "b", "d", (far - F.col("d")).alias("gain"), F.lit(1).cast("long").alias("na"),
                                   F.lit(1).cast("long").alias("nb")))
    average = F.col("linkage") == "average"
    out, turn = None, 0
    while True:
        edge = F.struct(F.col("d").alias("d"), F.col("a").alias("a"), F.col("b").alias("b"), F.col("na").alias("na"), F.col("nb").alias("nb"))
        ends = now.select("linkage", F.explode(F.array("a", "b")).alias("u"), edge.alias("e"))
        nearest = ends.groupBy("linkage", "u").agg(F.min("e").alias("e"))
        # An edge is both its clusters' nearest.
        merged = cut_lineage(nearest.groupBy("linkage", "e").agg(F.count(F.lit(1)).alias("n")).where("n = 2").select(
            "linkage", F.lit(turn).alias("turn"), "e.a", "e.b", F.col("e.d").alias("distance"), (F.col("e.na") + F.col("e.nb")).alias("size")))
        if merged.isEmpty():
            break
        out = merged if out is None else out.unionByName(merged)
        turn += 1
        moved = cut_lineage(merged.select("linkage", F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("a").alias("to")),
                                                                      F.struct(F.col("b").alias("u"), F.col("a").alias("to")))).alias("m"), "size")
                            .select("linkage", "m.u", "m.to", "size"))
        for end in ("a", "b"):
            to = moved.select("linkage", F.col("u").alias(end), F.col("to").alias(f"to_{end}"), F.col("size").alias(f"size_{end}"))
            now = now.join(to, ["linkage", end], "left")
        now = now.select("linkage", F.coalesce("to_a", "a").alias("x"), F.coalesce("to_b", "b").alias("y"), "d", "gain",
                         F.coalesce("size_a", "na").alias("nx"), F.coalesce("size_b", "nb").alias("ny"),
                         # Edges that a pair of clusters has, if none of its parts' are missing.
                         (F.when(F.col("to_a").isNull(), 1).otherwise(2) * F.when(F.col("to_b").isNull(), 1).otherwise(2)).alias("full"))
        way = F.col("x") < F.col("y")
        now = (now.where("x <> y").select("linkage", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "d", "gain", "full",
                                          F.when(way, F.col("nx")).otherwise(F.col("ny")).alias("na"),
                                          F.when(way, F.col("ny")).otherwise(F.col("nx")).alias("nb"))
               .groupBy("linkage", "a", "b").agg(F.min("d").alias("least"), F.max("d").alias("most"), F.sum("gain").alias("gain"),
                                                 F.max("na").alias("na"), F.max("nb").alias("nb"), F.count(F.lit(1)).alias("n"), F.max("full").alias("full"))
               .where((F.col("linkage") != "complete") | (F.col("n") == F.col("full"))))
        mean = F.lit(far) - F.col("gain") / (F.col("na") * F.col("nb"))
        distance = F.when(average, mean).when(F.col("linkage") == "single", F.col("least")).otherwise(F.col("most"))
        now = cut_lineage(now.select("linkage", "a", "b", distance.alias("d"), "gain", "na", "nb"))
        if turn % 8 == 0:
            out = cut_lineage(out)
    return cut_lineage(merged if out is None else out)


def cut_labels(nodes: DataFrame, merges: DataFrame, key: str, k_range=(2, 15)) -> DataFrame:
    """(linkage, k, key, cluster) for each k of the inclusive range.

    From ``k`` clusters on the dendrogram is cut between its greatest
    distances.  Where more clusters are left at its top, all merges that
    remain are at ``far`` and tie: the smallest clusters go together first, so the k - 1
    largest stay and one holds the others.  Clusters carry the least row of
    theirs; only ``k_range[1]`` clusters and merges of a linkage reach the driver."""
    low, high = k_range
    n = nodes.count()
    names = [r[0] for r in merges.select("linkage").distinct().collect()]
    height = Window.partitionBy("linkage").orderBy(F.desc("distance"), F.desc("turn"), F.desc("a"))
    last = {x: [] for x in names}
    for r in merges.withColumn("r", F.row_number().over(height)).where(F.col("r") <= high).orderBy("linkage", "r").collect():
        last[r.linkage].append((r.a, r.b, r.turn, r.distance))
    left = {r.linkage: n - r["count"] for r in merges.groupBy("linkage").count().collect()}
    # The merges that are undone for some k: as many from the top as there are clusters too few.
    undone = [(x, *m) for x in names for m in last[x][:max(0, high - left[x])]]
    below = merges
    if undone:
        gone = merges.sparkSession.createDataFrame([(u[0], u[1], u[2]) for u in undone], merges.select("linkage", "a", "b").schema)
        below = merges.join(F.broadcast(gone), ["linkage", "a", "b"], "left_anti")
    node = lambda c: F.struct("linkage", F.col(c).alias("k"))
    roots = connected_components(below.select(node("a").alias("a"), node("b").alias("b")))
    every = nodes.select(key, F.explode(F.array(*[F.lit(x) for x in names])).alias("linkage")) if names else None
    if every is None:
        return merges.sparkSession.createDataFrame([], f"linkage string, k int, {key} {nodes.schema[key].dataType.simpleString()}, "
                                                       f"cluster {nodes.schema[key].dataType.simpleString()}")
    base = cut_lineage(every.withColumn("node", node(key)).join(roots, "node", "left").select(
        "linkage", key, F.coalesce("root.k", key).alias("root")))
    sizes = Window.partitionBy("linkage").orderBy(F.desc("n"), "root")
    ranked = base.groupBy("linkage", "root").agg(F.count(F.lit(1)).alias("n")).withColumn("r", F.row_number().over(sizes)).where(F.col("r") <= high)
    largest = {x: [] for x in names}
    for r in ranked.orderBy("linkage", "r").collect():
        largest[r.linkage].append((r.root, r.n))
    renamed = []
    for x in names:
        for k in range(low, high + 1):
            to = {root: root for root, _ in largest[x]}
            size = dict(largest[x])
            # Redo undone merges, the lowest first, until k clusters are left.
            count, again = max(left[x], min(high, n)), [u for u in undone if u[0] == x][::-1]
            while count > k and again:
                _, a, b, *_ = again.pop(0)
                a, b = to[a], to[b]
                size[a] = size[a] + size.pop(b)
                to = {root: a if own == b else own for root, own in to.items()}
                count -= 1
            kept = sorted(size, key=lambda c: (-size[c], c))[:k - 1] if count > k else list(size)
            renamed += [(x, k, root, own) for root, own in to.items() if own in kept]
    kind = nodes.schema[key].dataType.simpleString()
    table = merges.sparkSession.createDataFrame(renamed, f"linkage string, k int, root {kind}, own {kind}")
    ks = F.explode(F.sequence(F.lit(low), F.lit(high))).alias("k")
    out = base.select("linkage", key, "root", ks).join(F.broadcast(table), ["linkage", "k", "root"], "left")
    # One row for each linkage and k: the name of the cluster that holds the others.
    rest = out.where("own is null").groupBy("linkage", "k").agg(F.min("root").alias("others"))
    return out.join(F.broadcast(rest), ["linkage", "k"], "left").select("linkage", "k", key, F.coalesce("own", "others").alias("cluster"))
