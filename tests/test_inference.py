"""Tests and tails: cross-checked against Commons Math distributions and a
LinearRegression p-value, on small frames."""
import numpy as np
from pyspark.sql import functions as F

from laborlens.functions import tails
from laborlens.operators import inference as I


def test_f_tail_matches_commons_math(spark):
    v = spark.range(1).select(tails.f_sf(F.lit(4.0), F.lit(3), F.lit(296)).alias("p")).first().p
    ref = 1 - spark._jvm.org.apache.commons.math3.distribution.FDistribution(3.0, 296.0).cumulativeProbability(4.0)
    assert abs(v - ref) < 1e-12


def test_t_tail_matches_commons_math(spark):
    v = spark.range(1).select(tails.t_sf2(F.lit(-2.1), F.lit(17)).alias("p")).first().p
    ref = 2 * spark._jvm.org.apache.commons.math3.distribution.TDistribution(17.0).cumulativeProbability(-2.1)
    assert abs(v - ref) < 1e-12


def test_norm_ppf(spark):
    v = spark.range(1).select(tails.norm_ppf(F.lit(0.975)).alias("z")).first().z
    assert abs(v - 1.959963984540054) < 1e-9


def _groups(spark):
    rng = np.random.default_rng(3)
    rows = [("a", float(x)) for x in rng.normal(10, 2, 40)] + [("b", float(x)) for x in rng.normal(11, 2, 60)] \
        + [("c", float(x)) for x in rng.normal(9, 3, 30)]
    return spark.createDataFrame(rows, "g string, y double"), rows


def test_anova_against_numpy(spark):
    df, rows = _groups(spark)
    r = I.anova(df, "g", "y").first()
    gs = {g: np.array([y for k, y in rows if k == g]) for g in "abc"}
    allv = np.concatenate(list(gs.values()))
    ssb = sum(len(v) * (v.mean() - allv.mean()) ** 2 for v in gs.values())
    ssw = sum(((v - v.mean()) ** 2).sum() for v in gs.values())
    f = (ssb / 2) / (ssw / (len(allv) - 3))
    assert abs(r.f_stat - f) < 1e-9 and r.df_between == 2 and r.df_within == len(allv) - 3
    ref = 1 - spark._jvm.org.apache.commons.math3.distribution.FDistribution(2.0, len(allv) - 3.0).cumulativeProbability(f)
    assert abs(r.p_value - ref) < 1e-10


def test_pooled_t_equals_regression_pvalue(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    df, _ = _groups(spark)
    two = df.where(F.col("g").isin("a", "b"))
    r = I.pairwise_ttests(two, "g", "y", ["a", "b"]).first()
    x = VectorAssembler(inputCols=["x"], outputCol="f").transform(two.withColumn("x", (F.col("g") == "a").cast("double")))
    m = LinearRegression(featuresCol="f", labelCol="y", solver="normal").fit(x)
    assert abs(abs(r.t_stat) - abs(m.summary.tValues[0])) < 1e-8
    assert abs(r.p_value - m.summary.pValues[0]) < 1e-8


def test_ttest2_needs_min_n(spark):
    df = spark.createDataFrame([(True, 1.0), (False, 2.0), (False, 3.0)], "f boolean, y double")
    r = I.ttest2(df, "f", "y").first()
    assert r.t_stat is None and r.n_true == 1 and r.n_false == 2


def test_constant_column_corr_is_null_not_error(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 5.0)], "x double, y double")
    assert I.pearson_test(df, "x", "y").first().r is None


def test_levene_equals_anova_on_deviations(spark):
    df, rows = _groups(spark)
    w = I.levene(df, "g", "y").first().w_stat
    gs = {g: np.array([y for k, y in rows if k == g]) for g in "abc"}
    z = {g: np.abs(v - np.median(v)) for g, v in gs.items()}
    allz = np.concatenate(list(z.values()))
    ssb = sum(len(v) * (v.mean() - allz.mean()) ** 2 for v in z.values())
    ssw = sum(((v - v.mean()) ** 2).sum() for v in z.values())
    assert abs(w - (ssb / 2) / (ssw / (len(allz) - 3))) < 1e-9
