"""Group and whole-table statistics (A-series).

All are single ``groupBy``/``agg`` passes (partial aggregation before the
shuffle); medians and quartiles come from the range-partitioned exact
quantiles in :mod:`quantiles` (or ``approx=True``).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar as S
from .quantiles import quantiles

_MEASURES = ("count", "mean", "median", "std", "min", "max")


def _nn(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.where(cond) if cond is not None else df


def distribution_stats(df: DataFrame, y: str, approx: bool = False) -> DataFrame:
    """Count, mean, median, sd (sample), min, q25, q50, q75, max."""
    x = {"count": F.count(y), "mean": F.avg(y), "std": F.stddev_samp(y), "min": F.min(y), "max": F.max(y)}
    q = quantiles(df, [], y, {"q25": 0.25, "median": 0.5, "q75": 0.75}, approx=approx, extra=x)
    return q.select(F.coalesce("count", F.lit(0)).cast("bigint").alias("count"), "mean", "median", "std", "min", "q25", "q75", "max")


def shape_stats(df: DataFrame, y: str) -> DataFrame:
    """A2: population skewness and excess kurtosis, with a direction label."""
    d = _nn(df, [y])
    return d.agg(F.skewness(y).alias("skewness"), F.kurtosis(y).alias("kurtosis")).withColumn(
        "direction", F.when(F.col("skewness") > 0, F.lit("right-skewed")).otherwise(F.lit("left-skewed")))


def group_stats(df: DataFrame, by: str, y: str, measures: Sequence[str] = _MEASURES,
                quantile_cols: dict | None = None, digits: int | None = 0, approx: bool = False,
                sort: bool = True) -> DataFrame:
    """Per-group count, mean, median, sd, min, max (and
    extra quantiles), rounded half-to-even, sorted by mean descending.
    Null keys and null measures are dropped first."""
    d = _nn(df.select(by, y), [by, y])
    aggs = {"count": F.count(y), "mean": F.avg(y), "std": F.stddev_samp(y), "min": F.min(y), "max": F.max(y)}
    aggs = {m: aggs[m] for m in measures if m in aggs}
    qs = {**({"median": 0.5} if "median" in measures else {}), **(quantile_cols or {})}
    base = quantiles(d, [by], y, qs, approx=approx, extra=aggs) if qs else d.groupBy(by).agg(*[c.alias(m) for m, c in aggs.items()])
    order = [m for m in measures] + [q for q in (quantile_cols or {}) if q not in measures]
    out = base.select(by, *[(F.col(m) if (digits is None or m == "count") else F.bround(m, digits)).alias(m) for m in order])
    return out.orderBy(F.desc("mean"), F.asc(by)) if sort and "mean" in measures else out


def growth_vs_base(stats: DataFrame, by: str, base_value: str, value: str = "mean") -> DataFrame:
    """A5: growth % of each group against the base group's (rounded) value;
    no figure when the base is <= 0 or missing."""
    b = stats.where(F.col(by) == base_value).select(F.col(value).alias("_base"))
    return (stats.where(F.col(by) != base_value).crossJoin(F.broadcast(b.limit(1)))
            .select(by, F.col(value), S.pct_growth(F.col(value), F.col("_base")).alias("growth_pct")))


def gap_to_best(stats: DataFrame, by: str, value: str = "mean") -> DataFrame:
    """Difference to the best group, absolute and %.  The window runs on
    the (small) summary, not on rows."""
    w = Window.partitionBy()
    best = F.max(value).over(w)
    return stats.select(by, F.col(value), (F.col(value) - best).alias("diff"),
                        S.pct(F.col(value) - best, best).alias("diff_pct"))


def market_stats(df: DataFrame, y: str, approx: bool = False) -> DataFrame:
    """Min, q25, median, q75, max, mean."""
    x = {"min": F.min(y), "max": F.max(y), "mean": F.avg(y)}
    q = quantiles(df, [], y, {"q25": 0.25, "median": 0.5, "q75": 0.75}, approx=approx, extra=x)
    return q.select("min", "q25", "median", "q75", "max", "mean")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A21."""
    return df.select(col).where(F.col(col).isNotNull()).distinct()


def regional_summary(stats: DataFrame, pairs: DataFrame, value: str = "mean",
                     flag: str = "significant") -> DataFrame:
    """Largest gap between group means; number of significant pairs."""
    g = stats.agg((F.max(value) - F.min(value)).alias("largest_gap"), F.count(F.lit(1)).alias("n_groups"))
    p = pairs.agg(F.count_if(F.col(flag)).alias("n_significant"), F.count(F.lit(1)).alias("n_pairs"))
    return g.crossJoin(p)


def transpose(df: DataFrame, key: str, value_cols: Sequence[str], keys_order: Sequence[str]) -> DataFrame:
    """Small summary transposed: rows become columns (fixed key list)."""
    long = df.unpivot([key], list(value_cols), "measure", "value")
    return long.groupBy("measure").pivot(key, list(keys_order)).agg(F.first("value"))


def pivot_matrix(df: DataFrame, row: str, col: str, val: str, values: Sequence[str], digits: int | None = 0) -> DataFrame:
    """Row x column matrix with a fixed column list; empty cell -> null."""
    v = F.bround(val, digits) if digits is not None else F.col(val)
    return df.select(row, col, v.alias(val)).groupBy(row).pivot(col, list(values)).agg(F.first(val))
