"""Hypothesis tests from sufficient statistics (T-series).

Rows are reduced once to per-group (n, mean, variance); every test is then
arithmetic on that small summary.  p-values use the JVM tails in
:mod:`laborlens.functions.tails`.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tails
from .gram import gram
from .quantiles import quantiles, value_counts


def group_moments(df: DataFrame, by: str, y: str) -> DataFrame:
    d = df.where(F.col(by).isNotNull() & F.col(y).isNotNull())
    return d.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.avg(y).alias("mean"), F.var_samp(y).alias("var"))


def anova_from_moments(m: DataFrame) -> DataFrame:
    """One-way ANOVA F with degrees of freedom and p-value."""
    g = m.agg(F.sum("n").alias("n_total"), F.count(F.lit(1)).alias("k_groups"),
              (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand"))
    j = m.crossJoin(F.broadcast(g))
    s = j.agg(F.sum(F.col("n") * (F.col("mean") - F.col("grand")) ** 2).alias("ssb"),
              F.sum((F.col("n") - 1) * F.coalesce(F.col("var"), F.lit(0.0))).alias("ssw"),
              F.first("n_total").alias("n_total"), F.first("k_groups").alias("k_groups"))
    df1 = F.col("k_groups") - 1
    df2 = F.col("n_total") - F.col("k_groups")
    # one group, or one row per group, has no F: null, not an error
    f = F.try_divide(F.try_divide(F.col("ssb"), df1), F.try_divide(F.col("ssw"), df2))
    return s.select(f.alias("f_stat"), df1.cast("bigint").alias("df_between"), df2.cast("bigint").alias("df_within"),
                    tails.f_sf(f, df1, df2).alias("p_value"))


def anova(df: DataFrame, by: str, y: str) -> DataFrame:
    """T2."""
    return anova_from_moments(group_moments(df, by, y))


def levene(df: DataFrame, by: str, y: str, approx: bool = False) -> DataFrame:
    """Levene / Brown-Forsythe with the group median as centre: ANOVA on
    |y - median(group)|.  Medians come from the exact ranked quantiles."""
    d = df.where(F.col(by).isNotNull() & F.col(y).isNotNull()).select(by, y)
    med = quantiles(d, [by], y, {"_med": 0.5}, approx=approx)
    z = d.join(med, by).select(by, F.abs(F.col(y) - F.col("_med")).alias("_z"))
    r = anova(z, by, "_z")
    return r.select(F.col("f_stat").alias("w_stat"), "df_between", "df_within", "p_value")


def pooled_t(n1, m1, v1, n2, m2, v2) -> tuple[Column, Column]:
    df = n1 + n2 - 2
    sp2 = F.try_divide((n1 - 1) * v1 + (n2 - 1) * v2, df)
    t = F.try_divide(m1 - m2, F.sqrt(sp2 * (F.lit(1.0) / n1 + F.lit(1.0) / n2)))
    return t, df


def welch_t(n1, m1, v1, n2, m2, v2) -> tuple[Column, Column]:
    a, b = v1 / n1, v2 / n2
    t = F.try_divide(m1 - m2, F.sqrt(a + b))
    df = F.try_divide((a + b) ** 2, F.try_divide(a * a, n1 - 1) + F.try_divide(b * b, n2 - 1))
    return t, df


def pairwise_ttests(df: DataFrame, by: str, y: str, order: Sequence[str], alpha: float = 0.05,
                    welch: bool = False) -> DataFrame:
    """T4 + J4: all unordered pairs of the listed groups (list order decides
    which is first), pooled (or Welch) t, Bonferroni alpha / pairs.  The
    self-join runs on the per-group summary, never on rows."""
    m = group_moments(df.where(F.col(by).isin(list(order))), by, y)
    pos = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(by))
    m = m.withColumn("_pos", pos)
    a = m.select(*[F.col(c).alias(f"a_{c}") for c in m.columns])
    b = m.select(*[F.col(c).alias(f"b_{c}") for c in m.columns])
    pairs = a.join(b, F.col("a__pos") < F.col("b__pos"))
    fn = welch_t if welch else pooled_t
    t, dfree = fn(F.col("a_n"), F.col("a_mean"), F.col("a_var"), F.col("b_n"), F.col("b_mean"), F.col("b_var"))
    n_pairs = len(order) * (len(order) - 1) // 2
    p = tails.t_sf2(t, dfree)
    return pairs.select(F.col(f"a_{by}").alias("group_1"), F.col(f"b_{by}").alias("group_2"),
                        (F.col("a_mean") - F.col("b_mean")).alias("mean_diff"), t.alias("t_stat"),
                        dfree.cast("double").alias("df"), p.alias("p_value"),
                        (p < F.lit(alpha / n_pairs)).alias("significant"))


def ttest2(df: DataFrame, flag: str, y: str, min_n: int = 30, welch: bool = False) -> DataFrame:
    """T5: group True vs False of a boolean flag, only when both sides have
    at least ``min_n`` rows; otherwise one row of nulls."""
    m = group_moments(df, flag, y)
    s = m.agg(*[F.max(F.when(F.col(flag) == v, F.col(c))).alias(f"{c}_{'t' if v else 'f'}")
                for v in (True, False) for c in ("n", "mean", "var")])
    ok = (F.coalesce(F.col("n_t"), F.lit(0)) >= min_n) & (F.coalesce(F.col("n_f"), F.lit(0)) >= min_n)
    fn = welch_t if welch else pooled_t
    t, dfree = fn(F.col("n_t"), F.col("mean_t"), F.col("var_t"), F.col("n_f"), F.col("mean_f"), F.col("var_f"))
    return s.select(F.coalesce("n_t", F.lit(0)).cast("bigint").alias("n_true"),
                    F.coalesce("n_f", F.lit(0)).cast("bigint").alias("n_false"),
                    F.when(ok, F.col("mean_t") - F.col("mean_f")).alias("mean_diff"),
                    F.when(ok, t).alias("t_stat"), F.when(ok, dfree.cast("double")).alias("df"),
                    F.when(ok, tails.t_sf2(t, dfree)).alias("p_value"))


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson r over rows where both are present; null (not an error) when
    either side is constant."""
    xx = F.when(y.isNotNull(), x)
    yy = F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_samp(xx, yy), F.stddev_samp(xx) * F.stddev_samp(yy))


def pearson_test(df: DataFrame, x: str, y: str) -> DataFrame:
    """R, n, t, p (two-sided)."""
    s = df.agg(safe_corr(F.col(x), F.col(y)).alias("r"),
               F.count_if(F.col(x).isNotNull() & F.col(y).isNotNull()).alias("n"))
    t = F.col("r") * F.sqrt(F.try_divide(F.col("n") - 2, F.lit(1.0) - F.col("r") ** 2))
    return s.select("r", "n", t.alias("t_stat"), tails.t_sf2(t, F.col("n") - 2).alias("p_value"))


def linear_trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares slope and intercept (null on constant x)."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def jarque_bera(df: DataFrame, y: str) -> DataFrame:
    """T1 re-aimed at the full column: JB = n/6 (S^2 + K^2/4), p = exp(-JB/2)."""
    s = df.where(F.col(y).isNotNull()).agg(F.count(F.lit(1)).alias("n"), F.skewness(y).alias("skewness"),
                                           F.kurtosis(y).alias("kurtosis"))
    jb = F.col("n") / 6.0 * (F.col("skewness") ** 2 + F.col("kurtosis") ** 2 / 4.0)
    return s.select("n", "skewness", "kurtosis", jb.alias("jb_stat"), tails.chi2_sf_2df(jb).alias("p_value"),
                    (tails.chi2_sf_2df(jb) > 0.05).alias("normal"))


def correlation_pairs(vec: DataFrame, arr: str, k: int, names: DataFrame) -> DataFrame:
    """Pairwise-complete Pearson r for every pair (i < j) of the ``k``
    positions of a numeric array column, any of which may be null.

    A row becomes the array of its shifted values (0 where null), their
    squares and the 0/1 marks of presence.  The products of all these columns
    hold, for each pair, the sums over the rows where both are present: one
    pass gives them all, and only the 3k x 3k sums reach the driver.  Values
    are shifted by those of the first complete row, which takes a common
    offset out of the sums.  A pair with a constant side, or with fewer than
    two complete rows, has r null.  ``names`` (pos, name) labels positions
    (1-based)."""
    import numpy as np

    spark = vec.sparkSession
    x = [F.col(arr)[i].cast("double") for i in range(k)]
    full = vec.where(F.col(arr).isNotNull() & ~F.exists(arr, lambda c: c.isNull())).select(arr).first() if k else None
    d = [c - F.lit(float(full[0][i] if full else 0.0)) for i, c in enumerate(x)]
    wide = F.array(*[F.coalesce(c, F.lit(0.0)) for c in d], *[F.coalesce(c * c, F.lit(0.0)) for c in d],
                   *[c.isNotNull().cast("double") for c in x])
    r = np.full((k, k), np.nan)
    if k:
        s = gram(vec.select(wide.alias("v")), "v", 3 * k)[None]
        val, sq, has = (slice(b * k, (b + 1) * k) for b in range(3))
        both = s[has, has]
        sx, sxx = s[val, has], s[sq, has]                            # of i, where j is present
        vx = both * sxx - sx * sx
        vx[vx <= 1e-10 * both * sxx] = 0.0                           # constant but for rounding
        with np.errstate(all="ignore"):
            r = (both * s[val, val] - sx * sx.T) / np.sqrt(vx * vx.T)
    rows = [(i + 1, j + 1, float(r[i, j]) if np.isfinite(r[i, j]) else None) for i in range(k) for j in range(i + 1, k)]
    long = spark.createDataFrame(rows, "p1 int, p2 int, r double")
    n1 = names.select(F.col("pos").alias("p1"), F.col("name").alias("var_1"))
    n2 = names.select(F.col("pos").alias("p2"), F.col("name").alias("var_2"))
    return long.join(n1, "p1").join(n2, "p2").select("var_1", "var_2", "r")


def kolmogorov_smirnov(df: DataFrame, y: str) -> DataFrame:
    """T1, second half: the largest distance between the distribution of
    ``y`` and the normal one with its mean and (sample) sd, over the whole
    column; p by the asymptotic Kolmogorov series.  Distinct values are
    counted and ranked, rows are not sorted.  Null on fewer than two rows or
    a constant column."""
    v = value_counts(df, [], y)
    m = df.agg(F.avg(y).alias("_mean"), F.stddev_samp(y).alias("_sd"))
    z = F.try_divide(F.col(y) - F.col("_mean"), F.col("_sd"))
    cdf = tails.norm_cdf(z)
    gap = F.greatest(F.col("_cum") / F.col("_n") - cdf, cdf - (F.col("_cum") - F.col("_c")) / F.col("_n"))
    s = v.crossJoin(F.broadcast(m)).select(gap.alias("_gap"), "_n").agg(F.max("_gap").alias("ks_stat"), F.max("_n").alias("n"))
    return s.select("n", "ks_stat", tails.kolmogorov_sf(F.col("ks_stat") * F.sqrt("n")).alias("p_value"))
