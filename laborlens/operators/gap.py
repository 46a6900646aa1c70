"""Curriculum vs market demand by category."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import scalar as S
from ..functions.text import str_array


def category_table(spark: SparkSession, categories=K.SKILL_CATEGORIES) -> DataFrame:
    """(category, skill, slug, ord): small dimension table."""
    rows = [(c, s, i) for i, (c, skills) in enumerate(categories) for s in skills]
    df = spark.createDataFrame(rows, "category string, skill string, ord int")
    return df.withColumn("slug", S.slug("skill"))


def flag_taught(df: DataFrame, col: str, taught) -> DataFrame:
    """Case-insensitive membership in the taught list."""
    low = [t.lower() for t in taught]
    return df.withColumn("taught", F.lower(F.col(col)).isin(low))


def skill_demand(rows: DataFrame, n_rows: DataFrame, skills: DataFrame | None = None, arr: str = "skill_slugs") -> DataFrame:
    """Percent of rows having each skill slug (``arr``: a row's distinct
    slugs).  ``skills``: count only these (a small table with ``slug``);
    others are then dropped in the row, before it is exploded."""
    items = F.col(arr)
    if skills is not None:
        items = F.array_intersect(items, str_array([r[0] for r in _bounded(skills.select("slug").distinct())]))
    g = rows.select(F.explode(items).alias("slug")).groupBy("slug").agg(F.count(F.lit(1)).alias("n"))
    return g.crossJoin(F.broadcast(n_rows)).select("slug", S.pct("n", "_n").alias("market_pct"))


def _bounded(df: DataFrame, most: int = 10_000) -> list:
    got = df.limit(most + 1).collect()
    if len(got) > most:
        raise ValueError(f"more than {most} rows of categories")
    return got


def category_demand(cats: DataFrame, demand: DataFrame) -> DataFrame:
    """Category rows joined to demand, default 0."""
    return cats.join(demand, "slug", "left").withColumn(
        "market_pct", F.coalesce("market_pct", F.lit(0.0)))


def category_rows(cats: DataFrame, rows: DataFrame, arr: str = "skill_slugs") -> DataFrame:
    """``category``, ``n``: rows that have a skill of the category.

    A row's skills become one mask with a bit per category (a word of 62 bits
    each); masks are counted, which combines before the shuffle, and only the
    few distinct masks are unfolded."""
    slugs: dict[str, list[str]] = {}
    for r in _bounded(cats.select("category", "slug").distinct().orderBy("category", "slug")):
        slugs.setdefault(r["category"], []).append(r["slug"])
    names = sorted(slugs)
    spark = cats.sparkSession
    if not names:
        return spark.createDataFrame([], "category string, n bigint")
    bits = [F.when(F.arrays_overlap(arr, str_array(slugs[c])), F.lit(1 << i % 62).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
            for i, c in enumerate(names)]
    words = [reduce(lambda a, b: a.bitwiseOR(b), bits[i:i + 62]) for i in range(0, len(bits), 62)]
    masks = rows.select(F.array(*words).alias("mask")).groupBy("mask").agg(F.count(F.lit(1)).alias("k"))
    table = spark.createDataFrame([(c, i // 62, 1 << i % 62) for i, c in enumerate(names)], "category string, word int, bit bigint")
    hit = masks.join(F.broadcast(table), F.get("mask", F.col("word")).bitwiseAND(F.col("bit")) != 0)
    return hit.groupBy("category").agg(F.sum("k").alias("n"))


def category_gap(cats: DataFrame, rows: DataFrame, n_rows: DataFrame, taught=K.TAUGHT_SKILLS, arr: str = "skill_slugs") -> DataFrame:
    """Per category: total skills, taught, coverage %, market % (sum of
    per-skill percentages, as published), market % of distinct postings,
    gap = market - coverage, status band; sorted by gap ascending.  ``rows``
    carry their distinct slugs in ``arr``."""
    c = flag_taught(cats, "skill", taught)
    d = category_demand(c, skill_demand(rows, n_rows, cats, arr))
    agg = d.groupBy("category").agg(F.count(F.lit(1)).alias("total"), F.count_if("taught").alias("taught"),
                                    F.sum("market_pct").alias("market_pct_sum"), F.min("ord").alias("ord"))
    any_ = category_rows(cats, rows, arr).crossJoin(F.broadcast(n_rows)).select("category", S.pct("n", "_n").alias("market_pct_any"))
    out = agg.join(any_, "category", "left").withColumn("market_pct_any", F.coalesce("market_pct_any", F.lit(0.0)))
    cov = S.pct("taught", "total")
    gap = F.col("market_pct_sum") - cov
    return out.select("category", gap.alias("gap"), cov.alias("coverage"), F.col("market_pct_sum").alias("market"),
                      "market_pct_any", F.col("taught").cast("bigint").alias("taught"),
                      F.col("total").cast("bigint").alias("total"),
                      S.band(gap, *K.GAP_BANDS).alias("status")).orderBy("gap", "category")


def gap_summary(gap: DataFrame) -> DataFrame:
    """Counts per status, strongest category (smallest gap)."""
    return gap.agg(F.count(F.lit(1)).alias("n_categories"),
                   F.count_if(F.col("gap") < 0).alias("n_excellent"),
                   F.count_if((F.col("gap") >= 0) & (F.col("gap") < 10)).alias("n_good"),
                   F.min_by("category", F.struct("gap", "category")).alias("top_strength"),
                   F.min("gap").alias("top_gap"))
