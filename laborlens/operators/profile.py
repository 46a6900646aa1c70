"""Profiling (P-series): each is one aggregate pass; per-column results are
computed in a single ``agg`` and then unpivoted, never one job per column."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from .quantiles import quantiles


def profile_extent(df: DataFrame, ts: str) -> DataFrame:
    """Rows, columns, first and last timestamp."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")) \
        .withColumn("n_columns", F.lit(len(df.columns)).cast("bigint"))


def profile_columns(df: DataFrame) -> DataFrame:
    """Column, type, non-null count (one pass for all columns)."""
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)])
    types = {f"c{i}": f.dataType.simpleString() for i, f in enumerate(df.schema.fields)}
    names = {f"c{i}": c for i, c in enumerate(df.columns)}
    long = row.unpivot([], list(names), "key", "non_null")
    m = F.create_map(*[F.lit(x) for k in names for x in (k, names[k])])
    t = F.create_map(*[F.lit(x) for k in types for x in (k, types[k])])
    return long.select(F.element_at(m, F.col("key")).alias("column"), F.element_at(t, F.col("key")).alias("dtype"),
                       F.col("non_null").cast("bigint").alias("non_null"))


def missing_report(df: DataFrame) -> DataFrame:
    """Missing count and % per column, only > 0, worst first."""
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}") for i, c in enumerate(cols)])
    names = {f"m{i}": c for i, c in enumerate(cols)}
    m = F.create_map(*[F.lit(x) for k in names for x in (k, names[k])])
    long = row.unpivot(["_n"], list(names), "key", "missing")
    return (long.where(F.col("missing") > 0)
            .select(F.element_at(m, F.col("key")).alias("column"), F.col("missing").cast("bigint").alias("missing"),
                    S.pct(F.col("missing"), F.col("_n")).alias("missing_pct"))
            .orderBy(F.desc("missing"), F.asc("column")))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """P5."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count")) \
        .orderBy(F.desc("count"), F.asc(col))


def code_crosswalk(df: DataFrame, label: str, code: str, key: str) -> DataFrame:
    """Label -> its code (1:1, so min is the first) and the row count."""
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(
        F.min(code).alias(code), F.count(key).alias("count"))


def coverage_stats(df: DataFrame, col: str) -> DataFrame:
    """Rows with / without a value, % with, min, max, mean, median."""
    base = df.agg(F.count(col).alias("n_with"), F.count_if(F.col(col).isNull()).alias("n_without"),
                  S.pct(F.count(col), F.count(F.lit(1))).alias("pct_with"),
                  F.min(col).alias("min"), F.max(col).alias("max"), F.avg(col).alias("mean"))
    return base.crossJoin(quantiles(df.select(col), [], col, {"median": 0.5}))


def array_coverage(df: DataFrame, arr: str) -> DataFrame:
    """Total items, mean items per row, rows with >= 1 item and %."""
    size = F.coalesce(F.size(arr), F.lit(0))
    return df.agg(F.sum(size).cast("bigint").alias("total_items"), F.avg(size).alias("mean_items"),
                  F.count_if(size > 0).alias("rows_with_items"),
                  S.pct(F.count_if(size > 0), F.count(F.lit(1))).alias("pct_with_items"))


def pipeline_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows and columns before and after the cleaning chain."""
    a = before.agg(F.count(F.lit(1)).alias("rows_before"))
    b = after.agg(F.count(F.lit(1)).alias("rows_after"))
    return a.crossJoin(b).withColumn("columns_before", F.lit(len(before.columns)).cast("bigint")) \
        .withColumn("columns_after", F.lit(len(after.columns)).cast("bigint"))


def target_split_stats(df: DataFrame, y: str) -> DataFrame:
    """P10: rows with / without the target and their %."""
    n = F.count(F.lit(1))
    return df.agg(F.count(y).alias("n_with"), (n - F.count(y)).alias("n_without"),
                  S.pct(F.count(y), n).alias("pct_with"), S.pct(n - F.count(y), n).alias("pct_without"))


def describe_numeric(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Count, mean, sd, min, quartiles, max per numeric column, long form
    (one row per column).  Unpivot first so the quartiles of all columns come
    from one ranked pass keyed by column name."""
    long = df.unpivot([], list(cols), "column", "value").select("column", F.col("value").cast("double").alias("value"))
    base = long.where(F.col("value").isNotNull()).groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    q = quantiles(long, ["column"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, approx=approx)
    return base.join(q, "column").select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")
