"""Two-group t-test and one-way ANOVA (H1-H4) from one aggregate pass.

The data-sized work is a single conditional aggregate (n, mean, sample
variance per group).  The statistic, degrees of freedom and effect size are
Column arithmetic on that one summary row; only the p-value and confidence
interval, which need the Student-t / F distribution, are computed by a small
Python helper over the one summary row (``mapInPandas``), since Spark has no
built-in t or F distribution function.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_summary(df: DataFrame, group_col: str, value_col: str, g1, g2) -> DataFrame:
    """One row: n, mean and sample variance of ``value_col`` for two groups
    (NULL and NaN values dropped)."""
    v = F.col(value_col)
    ok = v.isNotNull() & ~F.isnan(v)
    d = df.where(ok)
    aggs = []
    for i, g in ((1, g1), (2, g2)):
        sel = F.when(F.col(group_col) == g, v.cast("double"))
        aggs += [F.count(sel).cast("long").alias(f"n{i}"), F.avg(sel).alias(f"mean{i}"),
                 F.var_samp(sel).alias(f"var{i}")]
    return d.agg(*aggs)


def ttest(summary: DataFrame, welch="auto", min_size: int = 0) -> DataFrame:
    """H1/H2: T, dof, Welch flag and Cohen's d on a ``group_summary`` row.

    ``welch='auto'`` applies the Welch correction when the group sizes
    differ.  Groups of ``min_size`` or fewer give ``status='insufficient'``
    and NULL statistics."""
    n1, n2, m1, m2, v1, v2 = (F.col(c) for c in ("n1", "n2", "mean1", "mean2", "var1", "var2"))
    use_welch = (n1 != n2) if welch == "auto" else F.lit(bool(welch))
    se_w = F.sqrt(v1 / n1 + v2 / n2)
    sp2 = ((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)
    se_p = F.sqrt(sp2 * (1.0 / n1 + 1.0 / n2))
    dof_w = F.try_divide(F.pow(v1 / n1 + v2 / n2, 2), F.pow(v1 / n1, 2) / (n1 - 1) + F.pow(v2 / n2, 2) / (n2 - 1))
    ok = (n1 > min_size) & (n2 > min_size) & (n1 > 1) & (n2 > 1)
    se = F.when(use_welch, se_w).otherwise(se_p)
    return summary.select(
        "n1", "n2", "mean1", "mean2",
        F.when(ok, F.lit("ok")).otherwise(F.lit("insufficient")).alias("status"),
        F.when(ok, use_welch).alias("welch"),
        F.when(ok, F.try_divide(m1 - m2, se)).alias("t"),
        F.when(ok, F.when(use_welch, dof_w).otherwise((n1 + n2 - 2).cast("double"))).alias("dof"),
        F.when(ok, F.try_divide(m1 - m2, F.sqrt(sp2))).alias("cohen_d"),
        F.when(ok, se).alias("se"),
    )


def anova(df: DataFrame, group_col: str, value_col: str) -> DataFrame:
    """H4: one-way ANOVA F from per-group n, mean and variance (one groupBy,
    then a one-row combine)."""
    v = F.col(value_col).cast("double")
    g = (df.where(F.col(value_col).isNotNull() & F.col(group_col).isNotNull())
         .groupBy(group_col).agg(F.count(v).alias("n"), F.avg(v).alias("m"), F.var_samp(v).alias("var"),
                                 F.sum(v).alias("s")))
    tot = g.agg(F.sum("n").alias("n_total"), F.count(F.lit(1)).alias("k"), (F.sum("s") / F.sum("n")).alias("grand"))
    from larder.operators.aggregates import attach_one_row
    j = attach_one_row(g, tot)
    per = j.select("n_total", "k", (F.col("n") * F.pow(F.col("m") - F.col("grand"), 2)).alias("ssb"),
                   ((F.col("n") - 1) * F.coalesce(F.col("var"), F.lit(0.0))).alias("ssw"))
    out = per.groupBy("n_total", "k").agg(F.sum("ssb").alias("ssb"), F.sum("ssw").alias("ssw"))
    df_b = F.col("k") - 1
    df_w = F.col("n_total") - F.col("k")
    return out.select(df_b.cast("long").alias("df_between"), df_w.cast("long").alias("df_within"),
                      "ssb", "ssw", F.try_divide(F.try_divide(F.col("ssb"), df_b),
                                                 F.try_divide(F.col("ssw"), df_w)).alias("f"))


# --- distribution helper (one summary row; plain Python) ------------------------------

def _betacf(a: float, b: float, x: float) -> float:
    """Continued fraction of the regularised incomplete beta (modified Lentz)."""
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-15:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    ln_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(ln_front) * _betacf(a, b, x) / a
    return 1.0 - math.exp(ln_front) * _betacf(b, a, 1.0 - x) / b


def t_sf_two_sided(t: float, dof: float) -> float:
    return betainc(dof / 2.0, 0.5, dof / (dof + t * t))


def t_quantile(p: float, dof: float) -> float:
    """Upper quantile q with P(T <= q) = p (p > 0.5), by bisection."""
    lo, hi = 0.0, 1.0
    while 1.0 - t_sf_two_sided(hi, dof) / 2.0 < p:
        hi *= 2.0
    for _ in range(200):
        mid = (lo + hi) / 2.0
        if 1.0 - t_sf_two_sided(mid, dof) / 2.0 < p:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2.0


def f_sf(f: float, d1: float, d2: float) -> float:
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def with_t_pvalue(test: DataFrame, confidence: float = 0.95) -> DataFrame:
    """Add two-sided p-value and the confidence interval of the mean
    difference to a ``ttest`` row."""
    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            p, lo, hi = [], [], []
            for _, r in pdf.iterrows():
                if r["status"] != "ok" or pd.isna(r["t"]):
                    p.append(None), lo.append(None), hi.append(None)
                    continue
                q = t_quantile(0.5 + confidence / 2.0, r["dof"])
                diff = r["mean1"] - r["mean2"]
                p.append(t_sf_two_sided(r["t"], r["dof"]))
                lo.append(diff - q * r["se"])
                hi.append(diff + q * r["se"])
            yield pdf.assign(p_value=p, ci_low=lo, ci_high=hi)
    schema = test.schema.simpleString()[len("struct<"):-1] + ",p_value double,ci_low double,ci_high double"
    return test.coalesce(1).mapInPandas(fn, schema)


def with_f_pvalue(res: DataFrame) -> DataFrame:
    """Add the ANOVA p-value to an ``anova`` row."""
    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(p_value=[None if pd.isna(r["f"]) else f_sf(r["f"], r["df_between"], r["df_within"])
                                      for _, r in pdf.iterrows()])
    schema = res.schema.simpleString()[len("struct<"):-1] + ",p_value double"
    return res.coalesce(1).mapInPandas(fn, schema)
