"""Queries: the batch advisor (B-series, A17, A19, J1/J2 in profile form).

Every posting is a profile.  B4-B11 and A19 run on the raw per-skill
premiums (mean with minus mean without) so the oracle can recompute them;
B1-B3, B12, B13 use the fitted ridge model (rows-only).
"""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions import scalar as S
from ..operators import advisor as AD
from ..operators import aggregates as A
from ..operators import gap as G
from ..operators import models as M
from ..operators import skills as SK
from ..operators.quantiles import percentile_of_score
from ..session import stage
from ..sources.tables import read_table
from .catalog import register, rnd, with_ctes
from .q_models import _model, _once, feature_frame
from . import preprocess as PP
from .q_more import _PREM_ALL_SQL, feature_skills, premiums_raw
from .q_stats import Y, n_rows, proc, skill_rows, skill_sums


def _list(xs):
    return "[" + ", ".join("'" + x + "'" for x in xs) + "]"


_STATUS_SQL = (f"CASE WHEN list_contains({_list(K.ADVISOR_TAUGHT)}, replace(lower(skill), ' ', '_')) THEN 'taught' "
               f"WHEN list_contains({_list(K.CRITICAL_GAPS)}, replace(lower(skill), ' ', '_')) THEN 'gap' ELSE 'other' END")

_PROF_SQL = ("WITH " + _PREM_ALL_SQL + """,
t50 AS (SELECT list(skill) AS t50 FROM top50),
prof AS (SELECT vacancy_id AS user_id, experience_level, area_normalized AS city,
  list_distinct(list_filter(list_filter(list_transform(string_split(lower(trim(array_to_string(skills_all, ', '))), ','),
    lambda x: replace(trim(x), ' ', '_')), lambda x: x <> ''), lambda x: list_contains(t50, x))) AS skills
  FROM processed CROSS JOIN t50),
dem AS (SELECT skill AS slug, 100.0 * count(DISTINCT vacancy_id) / (SELECT count(*) FROM processed) AS market_pct
  FROM posting_skill GROUP BY skill)
""")


def _prof(spark, d):
    # first, as the others need no more columns than these
    p = AD.profiles_from_postings(skill_rows(spark, d, extra=("skills_all",)))
    return AD.with_valid_skills(p, feature_skills(spark, d))


def _prof_rows(spark, d):
    """:func:`_prof`, written once for a query with several branches over it."""
    return _once(("profiles", d), lambda: stage(_prof(spark, d).select("user_id", "skills", "experience_level", "city"), "profiles"))


def _market(spark, d):
    return AD.market_list(premiums_raw(spark, d), SK.demand_of(skill_sums(spark, d)))


@register("b04_skill_breakdown", with_ctes(
    _PROF_SQL + "SELECT user_id, skill, round(premium, 2) AS premium, " + _STATUS_SQL + " AS status, "
    "row_number() OVER (PARTITION BY user_id ORDER BY premium DESC, skill) AS rank "
    "FROM prof JOIN prem ON list_contains(prof.skills, prem.skill)"))
def b04(spark, d):
    r = AD.skill_breakdown(_prof(spark, d), _market(spark, d))
    return r.select("user_id", "skill", rnd("premium").alias("premium"), "status", F.col("rank").cast("bigint").alias("rank"))


@register("a19_total_premium", with_ctes(
    _PROF_SQL + "SELECT user_id, CAST(count(prem.skill) AS BIGINT) AS n_with_premium, round_even(coalesce(sum(premium), 0), 0) AS total_premium "
    "FROM prof LEFT JOIN prem ON list_contains(prof.skills, prem.skill) GROUP BY user_id"))
def a19(spark, d):
    r = AD.total_premium(_prof(spark, d), _market(spark, d))
    # whole KZT, as the study reports the total
    return r.select("user_id", "n_with_premium", F.bround("total_premium", 0).alias("total_premium"))


_P1, _P2 = K.CAREER_PATHS[0][1], K.CAREER_PATHS[1][1]


@register("b05_career_path", with_ctes(
    _PROF_SQL + f"""SELECT user_id, CASE WHEN c1 > c2 THEN '{K.CAREER_PATHS[0][0]}' ELSE '{K.CAREER_PATH_DEFAULT}' END AS path,
  round(CASE WHEN c1 > c2 THEN c1 ELSE c2 END, 6) AS match_pct,
  array_to_string(list_sort(list_filter(skills, lambda x: list_contains(CASE WHEN c1 > c2 THEN {_list(_P1)} ELSE {_list(_P2)} END, x))), '|') AS have,
  array_to_string(list_filter(CASE WHEN c1 > c2 THEN {_list(_P1)} ELSE {_list(_P2)} END, lambda x: NOT list_contains(skills, x)), '|') AS to_master
FROM (SELECT *, len(list_filter(skills, lambda x: list_contains({_list(_P1)}, x))) / {len(_P1)} * 100.0 AS c1,
  len(list_filter(skills, lambda x: list_contains({_list(_P2)}, x))) / {len(_P2)} * 100.0 AS c2 FROM prof)"""))
def b05(spark, d):
    p = _prof(spark, d).withColumn("skills", F.array_sort("skills"))
    r = AD.career_path(p)
    return r.select("user_id", "path", rnd("match_pct", 6).alias("match_pct"), "have", "to_master")


@register("b06_curriculum_status", with_ctes(
    "SELECT DISTINCT skill, " + _STATUS_SQL + " AS status FROM posting_skill"))
def b06(spark, d):
    s = PP.skill_long(skill_rows(spark, d, salary=False)).select("skill").distinct()
    return s.select("skill", AD.curriculum_status(F.col("skill")).alias("status"))


_REC_SQL = (_PROF_SQL + ", rec AS (SELECT user_id, skill, premium, row_number() OVER (PARTITION BY user_id ORDER BY premium DESC, skill) AS rank "
            "FROM prof CROSS JOIN prem WHERE NOT list_contains(prof.skills, prem.skill) QUALIFY rank <= 15) ")


@register("b08_recommend_skills", with_ctes(
    _REC_SQL + "SELECT user_id, rank, rec.skill, round(premium, 2) AS premium, round(coalesce(dem.market_pct, 0), 6) AS frequency, "
    "CASE WHEN premium < 100000 THEN 'standard' WHEN premium < 200000 THEN 'high' ELSE 'top' END AS tier, "
    + _STATUS_SQL.replace("skill", "rec.skill") + " AS status FROM rec LEFT JOIN dem ON dem.slug = rec.skill"))
def b08(spark, d):
    r = AD.recommend_skills(_prof(spark, d), _market(spark, d))
    return r.select("user_id", F.col("rank").cast("bigint").alias("rank"), "skill", rnd("premium").alias("premium"),
                    rnd("frequency", 6).alias("frequency"), "tier", "status")


@register("b09_critical_gaps", with_ctes(
    _PROF_SQL + f"SELECT user_id, g.skill, round(prem.premium, 2) AS premium, round(coalesce(dem.market_pct, 0), 6) AS frequency "
    f"FROM prof CROSS JOIN (SELECT unnest({_list(K.CRITICAL_GAPS)}) AS skill) g JOIN prem ON prem.skill = g.skill "
    "LEFT JOIN dem ON dem.slug = g.skill WHERE NOT list_contains(prof.skills, g.skill)"))
def b09(spark, d):
    r = AD.critical_gaps(_prof(spark, d), _market(spark, d))
    return r.select("user_id", "skill", rnd("premium").alias("premium"), rnd("frequency", 6).alias("frequency"))


@register("b10_curriculum_todo", with_ctes(
    _PROF_SQL + f", t AS (SELECT user_id, list_filter({_list(K.ADVISOR_TAUGHT)}, lambda x: NOT list_contains(skills, x) "
    "AND list_contains(pl, x)) AS todo FROM prof CROSS JOIN (SELECT list(skill) AS pl FROM prem)) "
    "SELECT user_id, CAST(i AS BIGINT) AS rank, todo[i] AS skill, round(prem.premium, 2) AS premium, CAST(len(todo) AS BIGINT) AS n_todo, "
    "len(todo) <= 10 AS shown FROM (SELECT user_id, todo, generate_subscripts(todo, 1) AS i FROM t WHERE len(todo) > 0) x "
    "JOIN prem ON prem.skill = x.todo[x.i]"))
def b10(spark, d):
    r = AD.curriculum_todo(_prof(spark, d), _market(spark, d))
    return r.select("user_id", F.col("rank").cast("bigint").alias("rank"), "skill", rnd("premium").alias("premium"), "n_todo", "shown")


@register("b11_action_plan", with_ctes(
    _REC_SQL + "SELECT user_id, rank, skill, round(premium, 2) AS premium, " + _STATUS_SQL + " AS status, "
    "coalesce(CASE replace(lower(skill), ' ', '_') WHEN 'redis' THEN '20' WHEN 'mongodb' THEN '30' WHEN 'elasticsearch' THEN '40' END, "
    "CASE WHEN replace(lower(skill), ' ', '_') IN ('docker', 'kubernetes', 'ci/cd') THEN '40-60' ELSE '30-50' END) AS hours "
    "FROM rec WHERE rank <= 3"))
def b11(spark, d):
    r = AD.action_plan(AD.recommend_skills(_prof(spark, d), _market(spark, d)))
    return r.select("user_id", F.col("rank").cast("bigint").alias("rank"), "skill", rnd("premium").alias("premium"),
                    "status", "hours")


@register("a17_percentile_of_score", "SELECT event_id, value, count(*) OVER (ORDER BY value RANGE BETWEEN UNBOUNDED PRECEDING "
          "AND CURRENT ROW) AS n_le, round(100.0 * count(*) OVER (ORDER BY value RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
          "/ count(*) OVER (), 6) AS percentile FROM events")
def a17(spark, d):
    ev = read_table(spark, d, "events")
    r = percentile_of_score(ev, "value", ev.select("event_id", "value"), "value", ["event_id"])
    return r.select("event_id", "value", "n_le", rnd("percentile", 6).alias("percentile"))


# ----------------------------------------------------- model-based (rows-only)

def _banded(spark, d, s):
    s = stage(s.select("user_id", "predicted_salary"), "scores")    # read by the order of the values and by both joins
    pct = percentile_of_score(proc(spark, d), Y, s.select("user_id", "predicted_salary"), "predicted_salary", ["user_id"])
    return s.join(pct.select("user_id", "percentile"), "user_id", "left").withColumn(
        "band", S.band("percentile", *K.PERCENTILE_BANDS))


def _scored(spark, d, prof=_prof):
    skill_rows(spark, d, extra=("skills_all", "name"))     # what both profiles and features need, written once
    prof, (_, names) = prof(spark, d), feature_frame(spark, d)
    ridge = _model(spark, d, "ridge")
    coef = M.coefficients(ridge, names, spark).select("name", "coefficient")
    return AD.linear_scores(prof, coef, ridge.intercept)


# A fixed coefficient table lets SQL recompute the scores.
_BASE, _STEP, _CITY, _SKILL = 250000.0, 90000.0, 40000.0, 1000.0
_BASE_SQL, _STEP_SQL, _CITY_SQL, _SKILL_SQL = "2.5e5", "9e4", "4e4", "1e3"


def _fixed_scores(spark, d, prof=_prof):
    prof = prof(spark, d)
    top = SK.top_of(skill_sums(spark, d), K.TOP_N_SKILLS)
    coef = top.select(F.concat(F.lit("skill_"), "skill").alias("name"), (F.col("rank") * _SKILL).alias("coefficient"))
    rest = spark.createDataFrame([("experience_level", _STEP), ("area_normalized_Almaty", _CITY)], "name string, coefficient double")
    return AD.linear_scores(prof, coef.unionByName(rest), _BASE)


_FIXED_SQL = _PROF_SQL + f""",
rk AS (SELECT map_from_entries(list((skill, rank))) AS m FROM (SELECT skill, row_number() OVER (ORDER BY n DESC, skill) AS rank FROM (
  SELECT skill, count(*) AS n FROM posting_skill WHERE skill IN (SELECT skill FROM top50) GROUP BY skill))),
sc AS (SELECT user_id, experience_level, {_BASE_SQL} + coalesce(list_sum(list_transform(skills, lambda x: {_SKILL_SQL} * m[x])), 0)
  + {_STEP_SQL} * experience_level + CASE WHEN city = 'Almaty' THEN {_CITY_SQL} ELSE 0 END AS pred FROM prof CROSS JOIN rk),
mk AS (SELECT list_sort(list(salary_monthly_kzt)) AS xs, count(*) AS n FROM processed),
le AS (SELECT pred, (SELECT count(*) FROM processed WHERE salary_monthly_kzt <= pred) AS k FROM (SELECT DISTINCT pred FROM sc))
"""


@register("b01_scores_fixed_coefficients", with_ctes(
    _FIXED_SQL + f"SELECT user_id, round(pred, 4) AS predicted_salary, CASE WHEN experience_level < 3 THEN round(pred + {_STEP_SQL}, 4) END AS next_level_salary, "
    f"CASE WHEN experience_level < 3 THEN round({_STEP_SQL}, 4) END AS level_gain, CASE WHEN experience_level < 3 THEN round(100.0 * {_STEP_SQL} / pred, 6) END AS level_gain_pct FROM sc"))
def b01f(spark, d):
    r = _fixed_scores(spark, d)
    return r.select("user_id", *[rnd(c, 4).alias(c) for c in ("predicted_salary", "next_level_salary", "level_gain")],
                    rnd("level_gain_pct", 6).alias("level_gain_pct"))


@register("b02_bands_fixed_coefficients", with_ctes(
    _FIXED_SQL + "SELECT user_id, round(100.0 * k / n, 6) AS percentile, " + "CASE "
    + " ".join(f"WHEN 100.0 * k / n < {c} THEN '{x}'" for c, x in zip(*K.PERCENTILE_BANDS)) + f" ELSE '{K.PERCENTILE_BANDS[1][-1]}' END AS band "
    "FROM sc JOIN le USING (pred) CROSS JOIN mk"))
def b02f(spark, d):
    return _banded(spark, d, _fixed_scores(spark, d)).select("user_id", rnd("percentile", 6).alias("percentile"), "band")


@register("b12_targets_fixed_coefficients", with_ctes(
    _FIXED_SQL + "SELECT user_id, round(pred * 1.2, 4) AS target_plus_20, (SELECT round(quantile_cont(salary_monthly_kzt, 0.75), 4) FROM processed) AS market_q75 FROM sc"))
def b12f(spark, d):
    r = _targets(spark, d, _fixed_scores(spark, d))
    return r.select("user_id", rnd("target_plus_20", 4).alias("target_plus_20"), rnd("market_q75", 4).alias("market_q75"))


@register("b01_score_profiles")
def b01(spark, d):
    """B1 + B3: ridge prediction per profile and the one-level-up what-if."""
    return _scored(spark, d).select("user_id", "predicted_salary", "next_level_salary", "level_gain", "level_gain_pct")


@register("b02_percentile_band")
def b02(spark, d):
    """B2: market percentile of each prediction and its band."""
    return _banded(spark, d, _scored(spark, d)).select("user_id", "predicted_salary", "percentile", "band")


def _targets(spark, d, scored):
    """Target salaries: +20 % and the market's upper quartile."""
    ms = A.market_stats(proc(spark, d), Y).select(F.col("q75").alias("market_q75"))
    return scored.crossJoin(F.broadcast(ms)).select(
        "user_id", (F.col("predicted_salary") * 1.2).alias("target_plus_20"), "market_q75",
        S.format_amount(F.col("predicted_salary") * 1.2).alias("target_text"))


@register("b12_targets")
def b12(spark, d):
    return _targets(spark, d, _scored(spark, d))


@register("b13_profile_summary")
def b13(spark, d):
    """One row per profile: recognised skills, prediction, percentile,
    path and the first recommendation."""
    return _summary(spark, d, _scored(spark, d, _prof_rows))


def _summary(spark, d, scored):
    prof = _prof_rows(spark, d)
    s = _banded(spark, d, scored)
    path = AD.career_path(prof).select("user_id", "path")
    first = AD.recommend_skills(prof, _market(spark, d), k=1).select(
        "user_id", F.col("skill").alias("first_recommendation"))
    return (prof.select("user_id", F.size("skills").cast("bigint").alias("n_skills")).join(s, "user_id")
            .join(path, "user_id").join(first, "user_id", "left"))


@register("b13_summary_fixed_coefficients", with_ctes(
    _FIXED_SQL + ", rec AS (SELECT user_id, prem.skill, row_number() OVER (PARTITION BY user_id ORDER BY premium DESC, prem.skill) AS rank "
    "FROM prof CROSS JOIN prem WHERE NOT list_contains(prof.skills, prem.skill) QUALIFY rank = 1), "
    f"cp AS (SELECT user_id, CASE WHEN c1 > c2 THEN '{K.CAREER_PATHS[0][0]}' ELSE '{K.CAREER_PATH_DEFAULT}' END AS path, n_skills FROM ("
    f"SELECT user_id, CAST(len(skills) AS BIGINT) AS n_skills, len(list_filter(skills, lambda x: list_contains({_list(_P1)}, x))) / {len(_P1)} * 100.0 AS c1, "
    f"len(list_filter(skills, lambda x: list_contains({_list(_P2)}, x))) / {len(_P2)} * 100.0 AS c2 FROM prof)) "
    "SELECT sc.user_id, n_skills, round(pred, 4) AS predicted_salary, round(100.0 * k / n, 6) AS percentile, CASE "
    + " ".join(f"WHEN 100.0 * k / n < {c} THEN '{x}'" for c, x in zip(*K.PERCENTILE_BANDS)) + f" ELSE '{K.PERCENTILE_BANDS[1][-1]}' END AS band, "
    "path, rec.skill AS first_recommendation FROM sc JOIN le USING (pred) CROSS JOIN mk JOIN cp USING (user_id) LEFT JOIN rec USING (user_id)"))
def b13f(spark, d):
    """B13 over the fixed coefficient table."""
    r = _summary(spark, d, _fixed_scores(spark, d, _prof_rows))
    return r.select("user_id", "n_skills", rnd("predicted_salary", 4).alias("predicted_salary"), rnd("percentile", 6).alias("percentile"),
                    "band", "path", "first_recommendation")
