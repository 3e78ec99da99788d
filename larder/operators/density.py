"""Kernel densities per group on a grid of points (A15, the curve of a violin).

Values are spread linearly over the bins of a fine grid, which one aggregate
with partial sums does for any number of rows, and a Gaussian kernel is summed
over the bins of a group, of which there is a fixed number.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bins and grid points of a group, and bandwidths that the grid goes beyond its ends.
BINS, POINTS, BEYOND = 512, 100, 2


def density(df: DataFrame, group: str, value: str, bins: int = BINS, points: int = POINTS, beyond: float = BEYOND) -> DataFrame:
    """(group, point, x, density) with the bandwidth std * n ** (-1/5).

    Rows without a group or a value are left out; a group with one value only
    (or one row) has no density and gives no rows."""
    v, g = F.col(value).cast("double"), F.col(group)
    # Equal values are counted first, so a hot group reaches the joins as its distinct values.
    held = df.where(g.isNotNull() & v.isNotNull() & ~F.isnan(v)).groupBy(g.alias("g"), v.alias("v")).agg(F.count(F.lit(1)).alias("c"))
    mean = F.sum(F.col("v") * F.col("c")) / F.sum("c")
    ends = held.groupBy("g").agg(F.sum("c").alias("n"), mean.alias("m"), F.min("v").alias("low"), F.max("v").alias("high"))
    ends = ends.where("low < high")
    far = F.col("v") - F.col("m")
    spread = held.join(ends.select("g", "m"), "g").groupBy("g").agg(F.sum(F.col("c") * far * far).alias("ss"))
    width = F.sqrt(F.col("ss") / (F.col("n") - 1)) * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    grid = ends.join(spread, "g").select("g", "n", width.alias("h"), "low", "high").select(
        "g", "n", "h", (F.col("low") - beyond * F.col("h")).alias("lo"),
        (F.col("high") - F.col("low") + 2 * beyond * F.col("h")).alias("range"))
    step = F.col("range") / (bins - 1)
    placed = held.join(grid, "g").withColumn("p", (F.col("v") - F.col("lo")) / step)
    share = F.col("p") - F.floor("p")
    parts = F.array(F.struct(F.floor("p").alias("bin"), ((1 - share) * F.col("c")).alias("w")),
                    F.struct((F.floor("p") + 1).alias("bin"), (share * F.col("c")).alias("w")))
    weights = placed.select("g", F.explode(parts).alias("s")).groupBy("g", "s.bin").agg(F.sum("s.w").alias("w"))
    folded = weights.groupBy("g").agg(F.collect_list(F.struct("bin", "w")).alias("bins"))  # at most bins + 1
    at = grid.join(folded, "g").select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")).withColumn(
        "x", F.col("lo") + F.col("point") * F.col("range") / (points - 1))

    def kernel(s):
        z = (F.col("x") - (F.col("lo") + s["bin"] * step)) / F.col("h")
        return s["w"] * F.exp(-0.5 * z * z)

    total = F.aggregate(F.transform("bins", kernel), F.lit(0.0), lambda acc, k: acc + k)
    return at.select(F.col("g").alias(group), F.col("point").cast("long"), "x",
                     (total / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))).alias("density"))
