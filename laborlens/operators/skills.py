"""Operators on the skills of postings.

Each row carries its distinct skills as an array.  A statistic per skill
explodes that array together with the measures it needs, so it is one
``groupBy(skill)`` without a join; "without the skill" is the total minus
the skill's own sums.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import scalar as S
from ..functions import tails

ARR = "skill_slugs"


def explode_items(rows: DataFrame, *cols: str, arr: str = ARR, item: str = "skill") -> DataFrame:
    """A row per posting and distinct skill, with the columns asked for."""
    return rows.select(*cols, F.explode(arr).alias(item))


def top_items(long: DataFrame, n: int, item: str = "skill") -> DataFrame:
    """Top-n items by number of rows (a row per posting and item; ties: item
    ascending) with their rank.  ``orderBy().limit()`` plans as a
    distributed top-k, and the window sees at most n rows."""
    counts = long.groupBy(item).agg(F.count(F.lit(1)).alias("n_postings"))
    top = counts.orderBy(F.desc("n_postings"), F.asc(item)).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n_postings"), F.asc(item))))


def item_frequency(long: DataFrame, n_rows: DataFrame, top: int | None = 20, item: str = "skill") -> DataFrame:
    """Count and % of rows per item; top-k by count."""
    g = long.groupBy(item).agg(F.count(F.lit(1)).alias("frequency"))
    g = g.crossJoin(F.broadcast(n_rows.select(F.col(n_rows.columns[0]).alias("_n"))))
    g = g.select(item, "frequency", S.pct("frequency", "_n").alias("percentage"))
    if top:
        g = g.orderBy(F.desc("frequency"), F.asc(item)).limit(top)
    return g


def item_sums(rows: DataFrame, y: str, arr: str = ARR, item: str = "skill") -> DataFrame:
    """Per item: rows that have it (``n_postings``), of those with a ``y``
    their number and sum, plus the whole table's totals (one broadcast row)."""
    r = rows.select(F.col(y).cast("double").alias("_y"), arr)
    tot = r.agg(F.count(F.lit(1)).alias("n_rows"), F.count("_y").alias("n_all"), F.sum("_y").alias("s_all"), F.var_pop("_y").alias("var_all"))
    per = explode_items(r, "_y", arr=arr, item=item).groupBy(item).agg(
        F.count(F.lit(1)).alias("n_postings"), F.count("_y").alias("n_with"), F.sum("_y").alias("s_with"))
    return per.crossJoin(F.broadcast(tot))


def top_of(sums: DataFrame, n: int, item: str = "skill") -> DataFrame:
    """:func:`top_items` from sums that are there."""
    top = sums.select(item, "n_postings").orderBy(F.desc("n_postings"), F.asc(item)).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n_postings"), F.asc(item))))


def demand_of(sums: DataFrame, item: str = "skill") -> DataFrame:
    """Percent of rows having each item, from sums that are there."""
    return sums.select(F.col(item).alias("slug"), S.pct("n_postings", "n_rows").alias("market_pct"))


def item_premium_raw(rows: DataFrame, y: str, min_n: int = 10, top: int | None = 20, arr: str = ARR,
                     item: str = "skill") -> DataFrame:
    """:func:`item_premium` of rows."""
    return item_premium(item_sums(rows, y, arr, item), min_n, top, item)


def item_premium(s: DataFrame, min_n: int = 10, top: int | None = 20, item: str = "skill") -> DataFrame:
    """A9 + T7 from the sums per item: mean with / without the item, premium,
    n with, the point-biserial correlation r = (m1 - m0) / s_pop * sqrt(p q)
    (null on a constant ``y``), its t, two-sided p and significance stars."""
    n0 = F.col("n_all") - F.col("n_with")
    m1 = F.try_divide("s_with", "n_with")
    m0 = F.try_divide(F.col("s_all") - F.col("s_with"), n0)
    p = F.try_divide("n_with", "n_all")
    # var_pop is a shifted sum of squares: exactly 0 on a constant, never negative
    r = F.when(F.col("var_all") > 0, F.try_divide(m1 - m0, F.sqrt("var_all")) * F.sqrt(p * (F.lit(1.0) - p)))
    out = s.where((F.col("n_with") > min_n) & (n0 > min_n)).select(
        item, m1.alias("mean_with"), m0.alias("mean_without"), (m1 - m0).alias("premium"),
        F.col("n_with").alias("count_with"), r.alias("correlation"), F.col("n_all"))
    out = out.withColumn("t_stat", S.try_corr_t("correlation", "n_all"))
    out = out.withColumn("p_value", tails.t_sf2("t_stat", F.col("n_all") - 2))
    out = out.withColumn("stars", S.band("p_value", *K.STAR_BANDS))
    if top:
        out = out.orderBy(F.desc("premium"), F.asc(item)).limit(top)
    return out


def item_by_group(rows: DataFrame, by: str, y: str, items: DataFrame, min_item_rows: int = 20, min_cell: int = 5,
                  min_groups: int = 2, arr: str = ARR, item: str = "skill") -> DataFrame:
    """A10: mean and count of ``y`` per (item, group) for the given items (a
    top-k list); items with fewer than ``min_item_rows`` rows skipped, cells
    below ``min_cell`` removed, items left with fewer than ``min_groups``
    cells removed.  The windows run on the (item, group) summary."""
    j = explode_items(rows, by, y, arr=arr, item=item).join(F.broadcast(items.select(item)), item)
    cell = j.groupBy(item, by).agg(F.avg(y).alias("mean"), F.count(F.lit(1)).alias("_rows"), F.count(y).alias("count"))
    w = Window.partitionBy(item)
    cell = cell.withColumn("_item_rows", F.sum("_rows").over(w))
    cell = cell.where((F.col("_item_rows") >= min_item_rows) & (F.col("count") >= min_cell))
    cell = cell.withColumn("_groups", F.count(F.lit(1)).over(w))
    return cell.where(F.col("_groups") >= min_groups).select(item, by, "mean", "count")


def indicator_rates(rows: DataFrame, by: str, items: DataFrame | None = None, arr: str = ARR, item: str = "skill") -> DataFrame:
    """Share of each group's rows having each item (group x item mean
    of the 0/1 indicator); ``items``: a top-k list."""
    r = rows.where(F.col(by).isNotNull()).select(by, arr)
    size = r.groupBy(by).agg(F.count(F.lit(1)).alias("_size"))
    lg = explode_items(r, by, arr=arr, item=item)
    if items is not None:
        lg = lg.join(F.broadcast(items.select(item)), item)
    cnt = lg.groupBy(by, item).agg(F.count(F.lit(1)).alias("_k"))
    return cnt.join(size, by).select(by, item, (F.col("_k") / F.col("_size")).alias("rate"))


def hot_array(rows: DataFrame, top: DataFrame, out: str, arr: str = ARR, item: str = "skill") -> DataFrame:
    """``rows`` with a 0/1 array over the ranked top list: each row compares
    the list (one row, at most n items) with the array that it carries."""
    names = top.agg(F.sort_array(F.collect_list(F.struct("rank", item))).alias("_top"))
    has = F.transform("_top", lambda t: F.array_contains(F.coalesce(F.col(arr), F.array().cast("array<string>")), t[item]).cast("double"))
    return rows.crossJoin(F.broadcast(names)).withColumn(out, has).drop("_top")


def multi_hot(rows: DataFrame, top: DataFrame, key: str = "vacancy_id", arr: str = ARR, item: str = "skill") -> DataFrame:
    """C11: per row a 0/1 string over the top items in rank order."""
    h = hot_array(rows.select(key, arr), top, "_hot", arr, item)
    return h.select(key, F.array_join(F.transform("_hot", lambda x: x.cast("int").cast("string")), "").alias("hot"))


def top_k_per_group(df: DataFrame, by: Sequence[str], score: str, k: int, tie: str) -> DataFrame:
    """Top-k rows per group by score (desc, then ``tie`` asc), zero
    scores removed."""
    w = Window.partitionBy(*by).orderBy(F.desc(score), F.asc(tie))
    return df.where(F.col(score) > 0).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
