"""Queries: aggregates over postings and skills (A-series)."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions import scalar as S
from ..operators import aggregates as A
from ..operators import skills as SK
from . import preprocess as PP
from ..session import stage
from .build import build_cache
from .catalog import register, rnd, with_ctes

Y = "salary_monthly_kzt"
MAJOR_SQL = "(" + ", ".join(f"'{c}'" for c in K.MAJOR_CITIES) + ")"
EXP_LABEL_SQL = ("CASE experience_level WHEN 0 THEN 'No Experience' WHEN 1 THEN '1-3 years' "
                 "WHEN 2 THEN '3-6 years' WHEN 3 THEN '6+ years' END")
REMOTE_SQL = f"regexp_matches(coalesce(schedule, ''), '(?i){K.REMOTE_PATTERN}')"


def proc(spark, d):
    """Processed postings for salary statistics: without the skill columns.
    Inside a query build they are written once as a slim table: the passes of
    the statistics, those for the fences too, read it and repeat no join."""
    cols = ["vacancy_id", "area_normalized", "experience_level", "schedule", "salary_raw_kzt"]
    cache = build_cache()
    if cache is not None and ("proc", d) in cache:
        return cache["proc", d]
    p = PP.processed_postings(spark, d, skills=False, winsorise=False).select(*cols)
    if cache is not None:
        p = stage(p, "salary-rows")
    p = capped(spark, d, p)
    if cache is not None:
        cache["proc", d] = p
    return p


def capped(spark, d, p):
    """``p`` with the winsorised salary; the fences are of its raw one."""
    return p.withColumn(Y, S.cap("salary_raw_kzt", *PP.salary_fences(spark, d, p)))


def major(spark, d):
    return proc(spark, d).where(F.col("area_normalized").isin(K.MAJOR_CITIES))


def with_labels(df):
    return df.withColumn("experience_label", S.decode_ordinal("experience_level"))


def _gs_sql(by, src, measures=("count", "mean", "median", "std", "min", "max"), extra=None):
    f = {"count": "count(salary_monthly_kzt) AS count",
         "mean": "round_even(avg(salary_monthly_kzt), 0) AS mean",
         "median": "round_even(quantile_cont(salary_monthly_kzt, 0.5), 0) AS median",
         "std": "round_even(stddev_samp(salary_monthly_kzt), 0) AS std",
         "min": "round_even(min(salary_monthly_kzt), 0) AS min",
         "max": "round_even(max(salary_monthly_kzt), 0) AS max"}
    cols = [f[m] for m in measures]
    for name, q in (extra or {}).items():
        cols.append(f"round_even(quantile_cont(salary_monthly_kzt, {q}), 0) AS {name}")
    return (f"SELECT {by}, {', '.join(cols)} FROM {src} WHERE salary_monthly_kzt IS NOT NULL "
            f"AND {by} IS NOT NULL GROUP BY {by}")


@register("a01_distribution_stats", with_ctes(
    "SELECT count(salary_monthly_kzt) AS count, round(avg(salary_monthly_kzt), 2) AS mean, "
    "round(quantile_cont(salary_monthly_kzt, 0.5), 2) AS median, round(stddev_samp(salary_monthly_kzt), 2) AS std, "
    "round(min(salary_monthly_kzt), 2) AS min, round(quantile_cont(salary_monthly_kzt, 0.25), 2) AS q25, "
    "round(quantile_cont(salary_monthly_kzt, 0.75), 2) AS q75, round(max(salary_monthly_kzt), 2) AS max "
    "FROM processed WHERE salary_monthly_kzt IS NOT NULL"))
def a01(spark, d):
    r = A.distribution_stats(proc(spark, d), Y)
    return r.select("count", *[rnd(c).alias(c) for c in ["mean", "median", "std", "min", "q25", "q75", "max"]])


@register("a02_shape_stats", with_ctes(
    "SELECT round(m3 / pow(m2, 1.5), 6) AS skewness, round(m4 / (m2 * m2) - 3, 6) AS kurtosis, "
    "CASE WHEN m3 / pow(m2, 1.5) > 0 THEN 'right-skewed' ELSE 'left-skewed' END AS direction FROM ("
    "SELECT avg(pow(x - mu, 2)) AS m2, avg(pow(x - mu, 3)) AS m3, avg(pow(x - mu, 4)) AS m4 FROM ("
    "SELECT salary_monthly_kzt AS x, avg(salary_monthly_kzt) OVER () AS mu FROM processed WHERE salary_monthly_kzt IS NOT NULL))"))
def a02(spark, d):
    r = A.shape_stats(proc(spark, d), Y)
    return r.select(rnd("skewness", 6).alias("skewness"), rnd("kurtosis", 6).alias("kurtosis"), "direction")


@register("a03_group_stats", with_ctes(_gs_sql("area_normalized", "processed")))
def a03(spark, d):
    return A.group_stats(proc(spark, d), "area_normalized", Y)


@register("a04_group_stats_experience", with_ctes(
    _gs_sql("experience_label", f"(SELECT *, {EXP_LABEL_SQL} AS experience_label FROM processed)",
            ("count", "mean", "median", "std"))))
def a04(spark, d):
    return A.group_stats(with_labels(proc(spark, d)), "experience_label", Y, ("count", "mean", "median", "std"))


@register("a05_growth_vs_base", with_ctes(
    "WITH s AS (" + _gs_sql("experience_label", f"(SELECT *, {EXP_LABEL_SQL} AS experience_label FROM processed)",
                            ("count", "mean")) + ") "
    "SELECT experience_label, mean, round(CASE WHEN b.base > 0 THEN (mean - b.base) / b.base * 100 END, 6) AS growth_pct "
    "FROM s CROSS JOIN (SELECT mean AS base FROM s WHERE experience_label = 'No Experience') b "
    "WHERE experience_label <> 'No Experience'"))
def a05(spark, d):
    s = A.group_stats(with_labels(proc(spark, d)), "experience_label", Y, ("count", "mean"), sort=False)
    r = A.growth_vs_base(s, "experience_label", "No Experience")
    return r.select("experience_label", "mean", rnd("growth_pct", 6).alias("growth_pct"))


QS = {"q25": 0.25, "q75": 0.75}


@register("a06_group_stats_quartiles", with_ctes(
    _gs_sql("area_normalized", f"(SELECT * FROM processed WHERE area_normalized IN {MAJOR_SQL})", extra=QS)))
def a06(spark, d):
    return A.group_stats(major(spark, d), "area_normalized", Y, quantile_cols=QS)


@register("a07_gap_to_best", with_ctes(
    "WITH s AS (" + _gs_sql("area_normalized", f"(SELECT * FROM processed WHERE area_normalized IN {MAJOR_SQL})",
                            ("count", "mean")) + ") "
    "SELECT area_normalized, mean, mean - max(mean) OVER () AS diff, "
    "round((mean - max(mean) OVER ()) / max(mean) OVER () * 100, 6) AS diff_pct FROM s"))
def a07(spark, d):
    s = A.group_stats(major(spark, d), "area_normalized", Y, ("count", "mean"), sort=False)
    r = A.gap_to_best(s, "area_normalized")
    return r.select("area_normalized", "mean", "diff", rnd("diff_pct", 6).alias("diff_pct"))


def skill_rows(spark, d, salary=True, extra=()):
    """Processed postings with the columns that skill statistics need: id,
    area, level, slugs, the winsorised salary if asked for, and ``extra``
    columns.  Inside a query build the rows are written once as a slim stage
    table and shared by all its branches; a branch that needs more columns
    than the table has comes first."""
    cols = ["vacancy_id", "area_normalized", "experience_level", "skill_slugs", *["salary_raw_kzt"] * salary, *extra]
    cache = build_cache()
    for key, rows in (cache or {}).items():
        if key[:2] == ("rows", d) and set(cols) <= set(key[2]):
            return rows
    p = PP.processed_postings(spark, d, winsorise=False).select(*cols)
    if cache is not None:
        p = stage(p, "skill-rows")
    if salary:
        p = capped(spark, d, p)
    if cache is not None:
        cache["rows", d, tuple(cols)] = p
    return p


def skill_sums(spark, d):
    """Per skill the counts and salary sums that the top list, the demand and
    the premiums are made of: one explode, written once per query build."""
    cache = build_cache()
    if cache is None:
        return SK.item_sums(skill_rows(spark, d), Y)
    if ("sums", d) not in cache:
        cache["sums", d] = stage(SK.item_sums(skill_rows(spark, d), Y), "skill-sums")
    return cache["sums", d]


def n_rows(p):
    return p.agg(F.count(F.lit(1)).alias("_n"))


@register("a08_item_frequency", with_ctes(
    "SELECT skill, count(*) AS frequency, round(100.0 * count(*) / (SELECT count(*) FROM processed), 6) AS percentage "
    "FROM posting_skill GROUP BY skill ORDER BY frequency DESC, skill LIMIT 20"))
def a08(spark, d):
    p = skill_rows(spark, d, salary=False)
    r = SK.item_frequency(PP.skill_long(p), n_rows(p), top=20)
    return r.select("skill", "frequency", rnd("percentage", 6).alias("percentage"))


_PREMIUM_SQL = """
WITH r AS (SELECT vacancy_id, salary_monthly_kzt AS y FROM processed WHERE salary_monthly_kzt IS NOT NULL),
t AS (SELECT count(*) AS n_all, sum(y) AS s_all, sum(y * y) AS ss_all FROM r),
per AS (SELECT skill, count(*) AS n_with, sum(y) AS s_with FROM posting_skill JOIN r USING (vacancy_id) GROUP BY skill),
x AS (SELECT skill, s_with / n_with AS m1, (s_all - s_with) / (n_all - n_with) AS m0, n_with, n_all,
        sqrt(ss_all / n_all - (s_all / n_all) * (s_all / n_all)) AS sd, n_with / n_all AS p
      FROM per CROSS JOIN t WHERE n_with > 10 AND n_all - n_with > 10)
SELECT skill, round(m1, 2) AS mean_with, round(m0, 2) AS mean_without, round(m1 - m0, 2) AS premium,
  n_with AS count_with, round((m1 - m0) / sd * sqrt(p * (1 - p)), 6) AS correlation
FROM x ORDER BY m1 - m0 DESC, skill LIMIT 20"""


@register("a09_item_premium", with_ctes(_PREMIUM_SQL))
def a09(spark, d):
    r = SK.item_premium(skill_sums(spark, d))
    return r.select("skill", *[rnd(c).alias(c) for c in ["mean_with", "mean_without", "premium"]], "count_with",
                    rnd("correlation", 6).alias("correlation"))


_TOP10_SQL = "(SELECT skill FROM posting_skill GROUP BY skill ORDER BY count(DISTINCT vacancy_id) DESC, skill LIMIT 10)"
_ITEM_GROUP_SQL = f"""
WITH cell AS (
  SELECT ps.skill, p.area_normalized, avg(p.salary_monthly_kzt) AS mean, count(*) AS rows_, count(p.salary_monthly_kzt) AS count
  FROM posting_skill ps JOIN {_TOP10_SQL} t USING (skill)
  JOIN (SELECT * FROM processed WHERE area_normalized IN {MAJOR_SQL}) p USING (vacancy_id)
  GROUP BY ps.skill, p.area_normalized),
f AS (SELECT * FROM (SELECT *, sum(rows_) OVER (PARTITION BY skill) AS item_rows FROM cell) WHERE item_rows >= 20 AND count >= 5),
g AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY skill) AS n_groups FROM f) WHERE n_groups >= 2)
"""


def _item_group(spark, d):
    p = skill_rows(spark, d)
    rows = p.where(F.col("area_normalized").isin(K.MAJOR_CITIES))
    return SK.item_by_group(rows, "area_normalized", Y, SK.top_of(skill_sums(spark, d), 10))


@register("a10_item_by_group", with_ctes(_ITEM_GROUP_SQL + "SELECT skill, area_normalized, round(mean, 2) AS mean, count FROM g"))
def a10(spark, d):
    r = _item_group(spark, d)
    return r.select("skill", "area_normalized", rnd("mean").alias("mean"), "count")


@register("a11_pivot_matrix", with_ctes(
    _ITEM_GROUP_SQL + "SELECT skill, " + ", ".join(
        f"round_even(max(CASE WHEN area_normalized = '{c}' THEN mean END), 0) AS \"{c}\"" for c in K.MAJOR_CITIES)
    + " FROM g GROUP BY skill"))
def a11(spark, d):
    return A.pivot_matrix(_item_group(spark, d), "skill", "area_normalized", "mean", K.MAJOR_CITIES, digits=0)


@register("a12_group_stats_remote", with_ctes(
    _gs_sql("is_remote", f"(SELECT *, {REMOTE_SQL} AS is_remote FROM processed WHERE area_normalized IN {MAJOR_SQL})",
            ("count", "mean", "median", "std"))))
def a12(spark, d):
    m = major(spark, d).withColumn("is_remote", S.flag_regex("schedule"))
    return A.group_stats(m, "is_remote", Y, ("count", "mean", "median", "std"))


_TOP50_SQL = "(SELECT skill FROM posting_skill GROUP BY skill ORDER BY count(DISTINCT vacancy_id) DESC, skill LIMIT 50)"


@register("a14_indicator_rates", with_ctes(
    f"WITH sz AS (SELECT area_normalized, count(*) AS size FROM processed GROUP BY 1), "
    f"k AS (SELECT p.area_normalized, ps.skill, count(*) AS k FROM posting_skill ps JOIN {_TOP50_SQL} t USING (skill) "
    f"JOIN processed p USING (vacancy_id) GROUP BY 1, 2) "
    f"SELECT area_normalized, skill, round(k / size, 6) AS rate FROM k JOIN sz USING (area_normalized)"))
def a14(spark, d):
    p = skill_rows(spark, d, salary=False)
    r = SK.indicator_rates(p, "area_normalized", SK.top_items(PP.skill_long(p), K.TOP_N_SKILLS))
    return r.select("area_normalized", "skill", rnd("rate", 6).alias("rate"))


@register("a18_market_stats", with_ctes(
    "SELECT round(min(salary_monthly_kzt), 2) AS min, round(quantile_cont(salary_monthly_kzt, 0.25), 2) AS q25, "
    "round(quantile_cont(salary_monthly_kzt, 0.5), 2) AS median, round(quantile_cont(salary_monthly_kzt, 0.75), 2) AS q75, "
    "round(max(salary_monthly_kzt), 2) AS max, round(avg(salary_monthly_kzt), 2) AS mean FROM processed"))
def a18(spark, d):
    r = A.market_stats(proc(spark, d), Y)
    return r.select(*[rnd(c).alias(c) for c in ["min", "q25", "median", "q75", "max", "mean"]])


@register("a21_distinct_values", with_ctes("SELECT DISTINCT area_normalized FROM processed0"))
def a21(spark, d):
    p = PP.normalize_locations(PP.postings(spark, d, with_description=False))
    return A.distinct_values(p, "area_normalized")


_EXP_ORDER = [K.EXPERIENCE_LABELS[i] for i in range(4)]


@register("a23_transpose", with_ctes(
    "WITH s AS (" + _gs_sql("experience_label", f"(SELECT *, {EXP_LABEL_SQL} AS experience_label FROM processed)",
                            ("count", "mean", "median", "std")) + "), "
    "l AS (SELECT experience_label, m AS measure, v FROM (UNPIVOT (SELECT experience_label, CAST(count AS DOUBLE) AS count, "
    "mean, median, std FROM s) ON count, mean, median, std INTO NAME m VALUE v)) "
    "SELECT measure, " + ", ".join(f"max(CASE WHEN experience_label = '{c}' THEN v END) AS \"{c}\"" for c in _EXP_ORDER)
    + " FROM l GROUP BY measure"))
def a23(spark, d):
    s = A.group_stats(with_labels(proc(spark, d)), "experience_label", Y, ("count", "mean", "median", "std"), sort=False)
    s = s.withColumn("count", F.col("count").cast("double"))
    return A.transpose(s, "experience_label", ["count", "mean", "median", "std"], _EXP_ORDER)

