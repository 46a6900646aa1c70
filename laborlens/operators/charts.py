"""The tables behind the study's charts (V-series); no pictures are drawn."""
from __future__ import annotations

import math
from functools import reduce
from operator import mul

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tails
from .quantiles import positions, quantiles


def histogram(df: DataFrame, y: str, bins: int = 50) -> DataFrame:
    """V1: equal-width bins over [min, max]; the last bin is closed on the
    right.  One pass for the range (1 row), one grouped count."""
    d = df.where(F.col(y).isNotNull())
    r = d.agg(F.min(y).alias("_lo"), F.max(y).alias("_hi"))
    w = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(w > 0, F.least(F.floor((F.col(y) - F.col("_lo")) / w), F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
    g = d.crossJoin(F.broadcast(r)).select(b.alias("bin"), "_lo", "_hi").groupBy("bin", "_lo", "_hi").agg(
        F.count(F.lit(1)).alias("count"))
    return g.select("bin", (F.col("_lo") + F.col("bin") * w).alias("bin_lo"),
                    (F.col("_lo") + (F.col("bin") + 1) * w).alias("bin_hi"), "count")


def box_stats(df: DataFrame, by: str, y: str, k: float = 1.5, approx: bool = False) -> DataFrame:
    """V2: quartiles, whiskers (most extreme values inside the fences) and
    the outlier count per group."""
    d = df.where(F.col(by).isNotNull() & F.col(y).isNotNull()).select(by, y)
    q = quantiles(d, [by], y, {"q1": 0.25, "median": 0.5, "q3": 0.75}, approx=approx)
    iqr = F.col("q3") - F.col("q1")
    q = q.withColumn("_lf", F.col("q1") - k * iqr).withColumn("_uf", F.col("q3") + k * iqr)
    inside = (F.col(y) >= F.col("_lf")) & (F.col(y) <= F.col("_uf"))
    j = d.join(q, by).groupBy(by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(y))).alias("whisker_lo"), F.max(F.when(inside, F.col(y))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"), F.count(F.lit(1)).alias("n"))
    return j


def qq_points(df: DataFrame, y: str) -> DataFrame:
    """V3: ordered values against normal quantiles at Filliben's plotting
    positions (the probability-plot convention), plus the least-squares fit
    of value on quantile.  Positions come from the counted distinct values."""
    r = positions(df, y)
    i = F.col("position").cast("double")
    n = F.col("_n").cast("double")
    last = F.pow(F.lit(0.5), F.lit(1.0) / n)
    m = (F.when(i == n, last).when(i == 1, F.lit(1.0) - last)
         .otherwise((i - 0.3175) / (n + 0.365)))
    pts = r.select(F.col(y).alias("ordered"), tails.norm_ppf(m).alias("theoretical"), i.alias("position"))
    fit = pts.agg(F.regr_slope("ordered", "theoretical").alias("slope"),
                  F.regr_intercept("ordered", "theoretical").alias("intercept"))
    return pts.crossJoin(F.broadcast(fit))


def density_curve(df: DataFrame, by: str, y: str, grid: int = 50, cells: int = 64, exact: bool = False) -> DataFrame:
    """V4: Gaussian kernel density per group on ``grid`` points between the
    group's min and max, bandwidth h by Scott's rule (sd * n^(-1/5)).

    Values fall into cells of h / ``cells``; a cell keeps the sums of the
    first powers of its values' distances from its middle, and the kernel of
    a value is expanded about the middle (Hermite polynomials up to the
    fourth).  What is left out is below 0.02 of the kernel's peak times
    (1 / 2 ``cells``)^5, some 1e-12.  So rows are read by one aggregate of
    five sums, and exponentials are taken per cell: their number grows with
    the fifth root of the rows.  ``exact=True`` sums a kernel per row."""
    d = df.where(F.col(by).isNotNull() & F.col(y).isNotNull()).select(by, F.col(y).cast("double").alias("_y"))
    s = d.groupBy(by).agg(F.count(F.lit(1)).alias("_n"), F.stddev_samp("_y").alias("_sd"),
                          F.min("_y").alias("_lo"), F.max("_y").alias("_hi"))
    s = s.withColumn("_h", F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2)))
    s = s.where(F.col("_h") > 0).select(by, "_n", "_h", "_lo", "_hi")
    j = d.join(s, by)
    if exact:
        j = j.withColumns({"_at": F.col("_y"), **{f"_m{k}": F.lit(float(k == 0)) for k in range(5)}})
    else:
        width = F.col("_h") / cells
        cell = F.floor((F.col("_y") - F.col("_lo")) / width)
        middle = F.col("_lo") + (F.col("_cell") + 0.5) * width
        u = (F.col("_y") - middle) / F.col("_h")
        j = j.withColumn("_cell", cell).withColumn("_u", u)
        j = j.groupBy(by, "_n", "_h", "_lo", "_hi", "_cell").agg(
            F.count(F.lit(1)).cast("double").alias("_m0"), *[F.sum(reduce(mul, [F.col("_u")] * k)).alias(f"_m{k}") for k in range(1, 5)])
        j = j.withColumn("_at", middle)

    def x(g: int):
        return F.col("_lo") + g * (F.col("_hi") - F.col("_lo")) / (grid - 1)

    def kernel(g: int):
        z = (x(g) - F.col("_at")) / F.col("_h")
        z2 = z * z
        if exact:
            return F.exp(-0.5 * z2)
        return F.exp(-0.5 * z2) * (F.col("_m0") + z * F.col("_m1") + (z2 - 1) / 2 * F.col("_m2") + z * (z2 - 3) / 6 * F.col("_m3")
                                   + (z2 * z2 - 6 * z2 + 3) / 24 * F.col("_m4"))

    agg = j.groupBy(by, "_n", "_h", "_lo", "_hi").agg(*[F.sum(kernel(g)).alias(f"_k{g}") for g in range(grid)])
    points = F.array(*[F.struct(F.lit(g).alias("g"), x(g).alias("x"), F.col(f"_k{g}").alias("k")) for g in range(grid)])
    return agg.select(by, "_n", "_h", F.explode(points).alias("p")).select(
        by, "p.g", "p.x", (F.col("p.k") / (F.col("_n") * F.col("_h") * math.sqrt(2 * math.pi))).alias("density"))


def mean_sd_series(stats: DataFrame, by: str) -> DataFrame:
    """V5: mean +- sd and mean vs median per group (from group stats)."""
    return stats.select(by, "mean", "median", (F.col("mean") - F.col("std")).alias("mean_minus_sd"),
                        (F.col("mean") + F.col("std")).alias("mean_plus_sd"),
                        (F.col("mean") - F.col("median")).alias("mean_minus_median"))
