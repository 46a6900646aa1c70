"""Advisor, chart, profiling and aggregate operators on literal frames,
with the fixture edge rows: duplicates in a user's list, a path tie, empty
groups, single-row groups, empty frames."""
import math

import numpy as np
from pyspark.sql import functions as F

from laborlens.operators import advisor as AD
from laborlens.operators import aggregates as A
from laborlens.operators import charts as V
from laborlens.operators import profile as P
from laborlens.operators import skills as SK


def _prof(spark, rows):
    return spark.createDataFrame(rows, "user_id int, skills array<string>, experience_level int, city string")


def test_career_path_tie_goes_to_default(spark):
    prof = _prof(spark, [(1, ["docker", "git"], 0, "Almaty"),      # 2/8 vs 1/8 -> devops
                         (2, ["git", "linux"], 0, "Almaty"),       # 1/8 vs 2/8 -> general
                         (3, ["git"], 0, "Almaty"),                # tie 1/8 = 1/8 -> general
                         (4, [], 0, "Almaty")])
    got = {r.user_id: (r.path, r.match_pct) for r in AD.career_path(prof).collect()}
    assert got[1] == ("DevOps/Infrastructure Specialist", 25.0)
    assert got[2][0] == got[3][0] == got[4][0] == "General Software Developer"
    assert got[4][1] == 0.0


def test_recommendations_exclude_held_and_rank_by_premium(spark):
    prof = _prof(spark, [(1, ["a"], 1, "X"), (2, [], 3, "Y")])
    prem = spark.createDataFrame([("a", 300000.0), ("b", 150000.0), ("c", 150000.0), ("redis", 50.0)], "skill string, premium double")
    dem = spark.createDataFrame([("a", 10.0), ("b", 5.0)], "slug string, market_pct double")
    recs = AD.recommend_skills(prof, AD.market_list(prem, dem), k=2).collect()
    by_user = {}
    for r in recs:
        by_user.setdefault(r.user_id, []).append((r.rank, r.skill, r.tier, r.frequency, r.status))
    assert by_user[1] == [(1, "b", "high", 5.0, "other"), (2, "c", "high", 0.0, "other")]  # tie b/c by name
    assert by_user[2][0] == (1, "a", "top", 10.0, "other")
    plan = AD.action_plan(AD.recommend_skills(prof, AD.market_list(prem, dem), k=15)).where("user_id = 2").collect()
    assert len(plan) == 3 and {r.hours for r in plan} == {"30-50"}
    gaps = AD.critical_gaps(prof, AD.market_list(prem, dem)).collect()
    assert {(r.user_id, r.skill) for r in gaps} == {(1, "redis"), (2, "redis")}


def test_total_premium_and_breakdown(spark):
    prof = _prof(spark, [(1, ["a", "b", "zzz"], 0, "X"), (2, ["zzz"], 0, "X")])
    prem = spark.createDataFrame([("a", 10.0), ("b", -4.0)], "skill string, premium double")
    tot = {r.user_id: (r.n_with_premium, r.total_premium) for r in AD.total_premium(prof, AD.market_list(prem)).collect()}
    assert tot == {1: (2, 6.0), 2: (0, 0.0)}
    br = [(r.skill, r.rank) for r in AD.skill_breakdown(prof, AD.market_list(prem)).where("user_id = 1").orderBy("rank").collect()]
    assert br == [("a", 1), ("b", 2)]


def test_valid_skills_distinct_and_unrecognised(spark):
    prof = spark.createDataFrame([(1, "Python, python, Machine Learning, cobol", 0, "X")],
                                 "user_id int, skills_text string, experience_level int, city string")
    top = spark.createDataFrame([("python",), ("machine_learning",)], "skill string")
    r = AD.with_valid_skills(prof, top).first()
    assert r.skills == ["python", "machine_learning"] and r.unrecognised == ["cobol"]


def test_linear_scores_and_what_if(spark):
    prof = _prof(spark, [(1, ["a"], 1, "Astana"), (2, [], 3, "Almaty")])
    coef = spark.createDataFrame([("skill_a", 100.0), ("experience_level", 10.0), ("area_normalized_Astana", 5.0)],
                                 "name string, coefficient double")
    got = {r.user_id: (r.predicted_salary, r.next_level_salary) for r in AD.linear_scores(prof, coef, 1000.0).collect()}
    assert got == {1: (1115.0, 1125.0), 2: (1030.0, None)}


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (5.0,), (10.0,)], "y double")
    h = {r.bin: r["count"] for r in V.histogram(df, "y", 5).collect()}
    assert h == {0: 2, 2: 1, 4: 1}  # 10.0 goes to the last bin


def test_box_stats_whiskers(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([("g", v) for v in vals], "g string, y double")
    r = V.box_stats(df, "g", "y").first()
    q1, q3 = np.quantile(vals, 0.25), np.quantile(vals, 0.75)
    assert (r.q1, r.q3) == (q1, q3)
    assert r.whisker_lo == 1.0 and r.whisker_hi == 4.0 and r.n_outliers == 1


def test_density_integrates_to_about_one(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([("g", float(x)) for x in rng.normal(0, 1, 400)], "g string, y double")
    d = sorted((r.x, r.density) for r in V.density_curve(df, "g", "y", 200).collect())
    area = sum((d[i + 1][0] - d[i][0]) * (d[i + 1][1] + d[i][1]) / 2 for i in range(len(d) - 1))
    assert 0.9 < area < 1.01


def test_qq_points_fit(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(float(x),) for x in rng.normal(50, 5, 300)], "y double")
    r = V.qq_points(df, "y").first()
    assert abs(r.slope - 5) < 1 and abs(r.intercept - 50) < 1


def test_group_stats_single_row_group_and_nulls(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 7.0), (None, 5.0), ("c", None)], "g string, y double")
    got = {r.g: r for r in A.group_stats(df, "g", "y", digits=None).collect()}
    assert set(got) == {"a", "b"}
    assert got["b"]["std"] is None and got["b"]["median"] == 7.0 and got["a"]["median"] == 2.0


def test_missing_report_and_value_counts(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None), (3, "k", "x")], "id int, a string, b string")
    rep = [(r.column, r.missing) for r in P.missing_report(df).collect()]
    assert rep == [("a", 2), ("b", 1)]
    vc = [(r.b, r["count"]) for r in P.value_counts(df, "b").collect()]
    assert vc == [("x", 2)]


def test_item_premium_totals_minus_item_sums(spark):
    rows = spark.createDataFrame([(i, float(i), [] if i % 2 else ["s"]) for i in range(30)],
                                 "vacancy_id int, y double, skill_slugs array<string>")
    r = SK.item_premium_raw(rows, "y", min_n=10, top=None).first()
    ys = np.arange(30.0)
    with_ = ys[::2]
    without = ys[1::2]
    assert math.isclose(r.premium, with_.mean() - without.mean())
    x = np.isin(np.arange(30), np.arange(0, 30, 2)).astype(float)
    assert math.isclose(r.correlation, np.corrcoef(x, ys)[0, 1], rel_tol=1e-9)


def test_empty_frame_aggregates(spark):
    df = spark.createDataFrame([], "g string, y double")
    assert A.group_stats(df, "g", "y").count() == 0
    assert A.distribution_stats(df, "y").count() in (0, 1)
    assert F is not None
