"""Edge shapes: nothing is lost, mislabelled or an error on them."""
import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from laborlens import constants as K
from laborlens.functions import scalar as S
from laborlens.functions import tails
from laborlens.operators import advisor as AD
from laborlens.operators import inference as I
from laborlens.operators import models as M
from laborlens.operators import quantiles as Q
from laborlens.operators import skills as SK
from laborlens.plans import preprocess as PP
from laborlens.plans import q_models


def rows_with_skills(spark, n=400, k=8, seed=0):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        has = [f"s{j}" for j in range(k) if rng.random() < 0.1 + 0.8 * (k - j) / k]
        level, city = int(rng.integers(0, 4)), ["Almaty", "Astana", "Other"][int(rng.integers(0, 3))]
        y = 1000.0 * level + sum(10.0 * (int(s[1:]) + 1) for s in has) + {"Almaty": 0.0, "Astana": 300.0, "Other": 700.0}[city]
        out.append((i, y, level, city, has))
    return spark.createDataFrame(out, "vacancy_id int, y double, experience_level int, area_normalized string, skill_slugs array<string>")


def test_coefficient_names_with_fewer_skills_than_the_top_list(spark):
    rows = rows_with_skills(spark)
    top = SK.top_items(PP.skill_long(rows), K.TOP_N_SKILLS)
    levels = M.levels_of(rows, "area_normalized")
    f = q_models.features_of(rows, top, levels)
    labels = q_models.feature_names([r["skill"] for r in top.orderBy("rank").collect()], levels)
    names = spark.createDataFrame(list(enumerate(labels)), "pos int, name string")
    got = {r["name"]: r.coefficient for r in M.coefficients(M.fit_ridge(f, "y", alpha=1e-9), names, spark).collect()}
    want = {f"skill_s{j}": 10.0 * (j + 1) for j in range(8)} | {"experience_level": 1000.0, "area_normalized_Other": 700.0, "area_normalized_Astana": 300.0}
    assert got.keys() == want.keys()
    assert all(abs(got[n] - w) < 1e-3 for n, w in want.items())


def test_unseen_level_is_the_base_level(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("c",), ("new",), (None,)], "g string")
    got = [list(r.v) for r in M.encode_onehot(rows, "g", ["c", "b", "a"], "v").collect()]
    assert got == [[0.0, 0.0], [0.0, 1.0], [1.0, 0.0], [0.0, 0.0], [0.0, 0.0]]
    with pytest.raises(ValueError):
        M.levels_of(rows, "g", most=2)


def test_correlations_of_every_pair_with_nulls_anywhere(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 5))
    x[:, 4] = 3.0
    rows = [[None if c < 3 and rng.random() < 0.2 else float(v) for c, v in enumerate(r)] for r in x]
    df = spark.createDataFrame([(r,) for r in rows], "v array<double>")
    names = spark.createDataFrame([(i + 1, f"n{i}") for i in range(5)], "pos int, name string")
    got = {(r.var_1, r.var_2): r.r for r in I.correlation_pairs(df, "v", 5, names).collect()}
    assert len(got) == 10
    for i in range(5):
        for j in range(i + 1, 5):
            both = np.array([(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None])
            want = None if 4 in (i, j) else np.corrcoef(both.T)[0, 1]
            r = got[f"n{i}", f"n{j}"]
            assert r is None if want is None else math.isclose(r, want, abs_tol=1e-9)
    assert I.correlation_pairs(df, "v", 1, names).count() == 0


def test_tests_on_degenerate_groups(spark):
    one = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "g string, y double")
    single = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "g string, y double")
    same = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("a", 1.0), ("b", 1.0)], "g string, y double")
    none = one.where("false")
    for df in (one, single, same, none):
        for test in (I.anova, I.levene):
            r = test(df, "g", "y").first()
            assert r is None or r[0] is None
        I.pairwise_ttests(df, "g", "y", ["a", "b"]).collect()
        I.pairwise_ttests(df, "g", "y", ["a", "b"], welch=True).collect()
        I.pearson_test(df.withColumn("x", F.col("y")), "x", "y").collect()
        I.jarque_bera(df, "y").collect()
        I.kolmogorov_smirnov(df, "y").collect()


def test_item_correlation_of_a_constant_is_null(spark):
    rows = spark.createDataFrame([(7.1e8 + 0.1, [] if i % 2 else ["s"]) for i in range(60)], "y double, skill_slugs array<string>")
    r = SK.item_premium_raw(rows, "y", top=None).first()
    assert r.correlation is None and r.p_value is None and r.stars is None and abs(r.premium) < 1e-6


def test_item_p_values_and_stars(spark):
    rng = np.random.default_rng(2)
    data = [(float(rng.normal()) + (3.0 if i % 2 == 0 else 0.0), (["a"] if i % 2 == 0 else []) + (["b"] if i % 3 == 0 else [])) for i in range(300)]
    got = {r.skill: r for r in SK.item_premium_raw(spark.createDataFrame(data, "y double, skill_slugs array<string>"), "y", top=None).collect()}
    assert got["a"].stars == "***" and got["a"].p_value < 1e-10
    assert got["b"].stars == ("***" if got["b"].p_value < 0.001 else "**" if got["b"].p_value < 0.01 else "*" if got["b"].p_value < 0.05 else "")


def test_kolmogorov_smirnov_against_a_sorted_pass(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=500), 1)
    r = I.kolmogorov_smirnov(spark.createDataFrame([(float(v),) for v in x], "y double"), "y").first()
    s, z = np.sort(x), (np.sort(x) - x.mean()) / x.std(ddof=1)
    cdf = np.array([0.5 * (1 + math.erf(v / math.sqrt(2))) for v in z])
    i = np.arange(1, 501)
    upper = np.array([(s <= v).mean() for v in s]) - cdf
    lower = cdf - np.array([(s < v).mean() for v in s])
    assert i.size == 500 and math.isclose(r.ks_stat, max(upper.max(), lower.max()), abs_tol=1e-9) and 0 <= r.p_value <= 1


def test_normal_quantile_is_plain_arithmetic(spark):
    p = [1e-9, 0.001, 0.02424, 0.3, 0.5, 0.9, 0.98, 1 - 1e-9, 0.0, 1.0]
    df = spark.createDataFrame([(v,) for v in p], "p double").withColumn("z", tails.norm_ppf("p"))
    got = [r.z for r in df.collect()]
    for v, z in zip(p[:-2], got[:-2], strict=True):
        assert math.isclose(z, NormalDist().inv_cdf(v), rel_tol=1e-12, abs_tol=1e-12)
    assert got[-2:] == [-math.inf, math.inf]
    assert "reflect" not in df._jdf.queryExecution().toString()


def test_base_currency_is_known(spark):
    df = spark.createDataFrame([(100.0, "KZT"), (1.0, "usd"), (5.0, "XYZ"), (7.0, None)], "a double, c string")
    keep = [r[0] for r in df.select(S.to_base_currency("a", "c")).collect()]
    null = [r[0] for r in df.select(S.to_base_currency("a", "c", unknown="null")).collect()]
    assert keep == [100.0, 480.0, 5.0, 7.0] and null == [100.0, 480.0, None, 7.0]


def test_hot_value_does_not_fill_a_task(spark):
    """A value in nine tenths of the rows is one row of the ranked table, and
    an exact quantile spreads evenly."""
    df = spark.range(50_000).select(F.when(F.col("id") % 10 > 0, F.lit(5.0)).otherwise(F.col("id") * 1.0).alias("v"))
    v = Q.value_counts(df, [], "v", partitions=8)
    assert v.where("v = 5.0").count() == 1 and v.agg(F.sum("_c")).first()[0] == 50_000
    s = Q.sorted_blocks(df.groupBy("v").count(), [], ["v"], partitions=8)
    sizes = [r["count"] for r in s.groupBy("_p").count().collect()]
    assert max(sizes) <= 2 * sum(sizes) / len(sizes)
    x = np.array([5.0 if i % 10 else float(i) for i in range(50_000)])
    got = Q.quantiles(df, [], "v", {"a": 0.05, "b": 0.5, "c": 0.97}).first()
    assert [got.a, got.b, got.c] == pytest.approx(list(np.quantile(x, [0.05, 0.5, 0.97])))
    p = Q.positions(df.limit(3000), "v", chunk=100)
    assert sorted(r.position for r in p.collect()) == list(range(1, 3001))


def test_career_path_over_any_number_of_paths(spark):
    prof = spark.createDataFrame([(1, ["a", "b"]), (2, ["c"]), (3, []), (4, ["a", "b", "c", "d"])], "user_id int, skills array<string>")
    paths = [("X", ["a", "b"]), ("Y", ["c", "d"]), ("Z", ["e"])]
    got = {r.user_id: (r.path, r.match_pct, r.to_master) for r in AD.career_path(prof, AD.path_table(spark, paths), "Z").collect()}
    assert got == {1: ("X", 100.0, ""), 2: ("Y", 50.0, "d"), 3: ("Z", 0.0, "e"), 4: ("Z", 0.0, "e")}


def test_market_list_asserts_its_bound(spark):
    prem = spark.createDataFrame([(f"s{i}", float(i)) for i in range(51)], "skill string, premium double")
    prof = spark.createDataFrame([(1, ["s1"])], "user_id int, skills array<string>")
    with pytest.raises(Exception, match="more than 50 feature skills"):
        AD.recommend_skills(prof, AD.market_list(prem)).collect()
    assert AD.recommend_skills(prof, AD.market_list(prem.limit(50))).count() == 15


def test_todo_lists_are_flagged_not_dropped(spark):
    taught = list(dict.fromkeys(K.ADVISOR_TAUGHT))
    prem = spark.createDataFrame([(s, 1.0) for s in taught], "skill string, premium double")
    prof = spark.createDataFrame([(1, []), (2, taught[3:])], "user_id int, skills array<string>")
    got = AD.curriculum_todo(prof, AD.market_list(prem)).collect()
    assert {(r.user_id, r.n_todo, r.shown) for r in got} == {(1, len(taught), len(taught) <= 10), (2, 3, True)}
    assert [r.skill for r in got if r.user_id == 2] == taught[:3]


def test_kmeans_takes_the_best_of_its_starts(spark):
    rng = np.random.default_rng(5)
    pts = np.concatenate([rng.normal(size=(40, 2)) + c for c in ((0, 0), (6, 0), (0, 6), (6, 6))])
    df = M.assemble(spark.createDataFrame([([float(a), float(b)],) for a, b in pts], "a array<double>"), ["a"]).select("features").cache()
    best = M.kmeans_fit(df, 4).summary.trainingCost
    assert best <= min(M.kmeans_fit(df, 4, seed=K.SPLIT_SEED + i, n_init=1).summary.trainingCost for i in range(K.KMEANS_STARTS)) + 1e-9


def test_cross_validation_against_a_hand_loop(spark):
    rows = rows_with_skills(spark, n=103)
    f = q_models.features_of(rows, SK.top_items(PP.skill_long(rows), 50), ["Other", "Astana", "Almaty"])
    got = {r.model: r for r in M.cross_validate(f, "y", key="vacancy_id").collect()}
    assert got.keys() == {"ridge", "lasso"} and got["ridge"].folds == 5
    data = sorted((r.vacancy_id, r.y, r.features.toArray()) for r in f.collect())
    x, y = np.array([d[2] for d in data]), np.array([d[1] for d in data])
    sizes, r2, at = [21, 21, 21, 20, 20], [], 0
    for n in sizes:
        test = np.zeros(103, bool)
        test[at:at + n] = True
        at += n
        xc, yc = x[~test] - x[~test].mean(0), y[~test] - y[~test].mean()
        w = np.linalg.solve(xc.T @ xc + K.RIDGE_ALPHA * np.eye(x.shape[1]), xc.T @ yc)
        e = y[test] - y[~test].mean() - (x[test] - x[~test].mean(0)) @ w
        r2.append(1 - (e**2).sum() / ((y[test] - y[test].mean()) ** 2).sum())
    assert math.isclose(got["ridge"].cv_mean, np.mean(r2), rel_tol=1e-4) and math.isclose(got["ridge"].cv_std, np.std(r2), rel_tol=1e-2, abs_tol=1e-5)


def test_imputed_rows_without_prediction_stay(spark):
    rows = spark.createDataFrame([(1, 5.0), (2, None), (3, None)], "vacancy_id int, y double")
    pred = spark.createDataFrame([(1, 9.0), (2, 8.0)], "vacancy_id int, prediction double")
    got = {r.vacancy_id: (r.salary_imputed, r.is_imputed) for r in M.attach_predictions(rows, pred, "y").collect()}
    assert got == {1: (5.0, False), 2: (8.0, True), 3: (None, True)}
