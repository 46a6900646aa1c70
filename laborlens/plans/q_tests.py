"""Queries: hypothesis tests and correlations (T-series)."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions import scalar as S
from ..operators import inference as I
from ..operators import skills as SK
from . import preprocess as PP
from .catalog import register, rnd, with_ctes
from .q_stats import MAJOR_SQL, REMOTE_SQL, Y, major, proc, skill_rows, skill_sums

_Y = "(SELECT area_normalized AS g, salary_monthly_kzt AS y, * FROM processed WHERE salary_monthly_kzt IS NOT NULL)"


def beta_sql(x, a, b, steps=400):
    """Regularised incomplete beta I_x(a, b) in SQL: one minus the integral
    over the upper end, by Simpson's rule after the substitution t = 1 - u^2,
    which takes the singularity of b = 1/2 away."""
    u = f"(i * sqrt(1 - {x}) / {steps})"
    return (f"(1 - exp(lgamma({a} + {b}) - lgamma({a}) - lgamma({b})) * sqrt(1 - {x}) / {steps} / 3 * "
            f"list_sum(list_transform(range(0, {steps} + 1), lambda i: (CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) "
            f"* 2 * pow({u}, 2 * {b} - 1) * pow(1 - {u} * {u}, {a} - 1))))")


def t_p_sql(t, df):
    """Two-sided p of Student's t."""
    x = f"({df} / ({df} + {t} * {t}))"
    return f"({beta_sql(x, f'({df} / 2.0)', '0.5')})"


def f_p_sql(f, d1, d2):
    """Upper tail of the F distribution."""
    return f"({beta_sql(f'({d2} / ({d2} + {d1} * {f}))', f'({d2} / 2.0)', f'({d1} / 2.0)')})"


def _anova_sql(src, digits=6):
    """``digits=None`` leaves F as it is, for what is computed from it."""
    shown = (lambda x: x) if digits is None else (lambda x: f"round({x}, {digits})")
    return (f"WITH m AS (SELECT g, count(*) AS n, avg(y) AS mean, var_samp(y) AS var FROM {src} WHERE g IS NOT NULL GROUP BY g), "
            "a AS (SELECT sum(n) AS nn, count(*) AS k, sum(n * mean) / sum(n) AS grand FROM m) "
            f"SELECT {shown('(sum(n * (mean - grand) * (mean - grand)) / (k - 1)) / (sum((n - 1) * coalesce(var, 0)) / (nn - k))')} AS f_stat, "
            "CAST(k - 1 AS BIGINT) AS df_between, CAST(nn - k AS BIGINT) AS df_within FROM m CROSS JOIN a GROUP BY k, nn")


@register("t01_normality_jb", with_ctes(
    "SELECT n, round(s, 6) AS skewness, round(k, 6) AS kurtosis, round(n / 6.0 * (s * s + k * k / 4.0), 4) AS jb_stat, "
    "round(exp(-(n / 6.0 * (s * s + k * k / 4.0)) / 2), 6) AS p_value, exp(-(n / 6.0 * (s * s + k * k / 4.0)) / 2) > 0.05 AS normal "
    "FROM (SELECT n, m3 / pow(m2, 1.5) AS s, m4 / (m2 * m2) - 3 AS k FROM (SELECT count(*) AS n, avg(pow(x - mu, 2)) AS m2, "
    "avg(pow(x - mu, 3)) AS m3, avg(pow(x - mu, 4)) AS m4 FROM (SELECT salary_monthly_kzt AS x, avg(salary_monthly_kzt) OVER () AS mu "
    "FROM processed WHERE salary_monthly_kzt IS NOT NULL)))"))
def t01(spark, d):
    r = I.jarque_bera(proc(spark, d), Y)
    return r.select("n", rnd("skewness", 6).alias("skewness"), rnd("kurtosis", 6).alias("kurtosis"),
                    rnd("jb_stat", 4).alias("jb_stat"), rnd("p_value", 6).alias("p_value"), "normal")


_PHI_SQL = ("(0.5 + sign(z) * abs(z) / 400 / 3 / sqrt(2 * pi()) * list_sum(list_transform(range(0, 401), lambda i: "
            "(CASE WHEN i = 0 OR i = 400 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * exp(-0.5 * pow(i * abs(z) / 400, 2)))))")


@register("t01_normality_ks", with_ctes(
    "SELECT n, round(d, 6) AS ks_stat, round(least(greatest(CASE WHEN d * sqrt(n) < 0.2 THEN 1 ELSE list_sum(list_transform(range(1, 101), "
    "lambda k: CASE WHEN k % 2 = 1 THEN 2 ELSE -2 END * exp(-2.0 * k * k * d * d * n))) END, 0), 1), 6) AS p_value FROM ("
    "SELECT count(*) AS n, max(greatest(hi / nn - phi, phi - lo / nn)) AS d FROM (SELECT *, " + _PHI_SQL + " AS phi FROM ("
    "SELECT (y - avg(y) OVER ()) / stddev_samp(y) OVER () AS z, count(*) OVER (ORDER BY y RANGE UNBOUNDED PRECEDING) AS hi, "
    "rank() OVER (ORDER BY y) - 1 AS lo, count(*) OVER () AS nn FROM (SELECT salary_monthly_kzt AS y FROM processed "
    "WHERE salary_monthly_kzt IS NOT NULL)))) "))
def t01k(spark, d):
    """Kolmogorov-Smirnov distance to the normal distribution, whole column."""
    r = I.kolmogorov_smirnov(proc(spark, d), Y)
    return r.select("n", rnd("ks_stat", 6).alias("ks_stat"), rnd("p_value", 6).alias("p_value"))


@register("t02_anova", with_ctes(_anova_sql(_Y)))
def t02(spark, d):
    r = I.anova(proc(spark, d), "area_normalized", Y)
    return r.select(rnd("f_stat", 6).alias("f_stat"), "df_between", "df_within")


@register("t03_levene", with_ctes(
    _anova_sql(f"(SELECT s.g, abs(s.y - m.med) AS y FROM {_Y} s JOIN (SELECT g, quantile_cont(y, 0.5) AS med FROM {_Y} "
               "GROUP BY g) m USING (g))").replace("AS f_stat", "AS w_stat")))
def t03(spark, d):
    r = I.levene(proc(spark, d), "area_normalized", Y)
    return r.select(rnd("w_stat", 6).alias("w_stat"), "df_between", "df_within")


_PAIR_SQL = f"""
WITH m AS (SELECT g, count(*) AS n, avg(y) AS mean, var_samp(y) AS var,
    list_position([{', '.join("'" + c + "'" for c in K.MAJOR_CITIES)}], g) AS pos
  FROM {_Y} WHERE g IN {MAJOR_SQL} GROUP BY g)
SELECT a.g AS group_1, b.g AS group_2, round(a.mean - b.mean, 2) AS mean_diff,
  (a.mean - b.mean) / sqrt(((a.n - 1) * a.var + (b.n - 1) * b.var) / (a.n + b.n - 2) * (1.0 / a.n + 1.0 / b.n)) AS t,
  CAST(a.n + b.n - 2 AS DOUBLE) AS df
FROM m a JOIN m b ON a.pos < b.pos"""
_PAIR_SUB = "(" + _PAIR_SQL.replace("\nWITH m AS", "WITH m AS") + ")"


@register("t04_pairwise_ttests", with_ctes("SELECT * EXCLUDE (t), round(t, 6) AS t_stat FROM " + _PAIR_SUB))
def t04(spark, d):
    r = I.pairwise_ttests(proc(spark, d), "area_normalized", Y, K.MAJOR_CITIES)
    return r.select("group_1", "group_2", rnd("mean_diff").alias("mean_diff"), rnd("t_stat", 6).alias("t_stat"), "df")


_PAIR_P_SQL = (f"SELECT * EXCLUDE (t), round(t, 6) AS t_stat, round({t_p_sql('t', 'df')}, 6) AS p_value, "
               f"{t_p_sql('t', 'df')} < 0.05 / 6 AS significant FROM " + _PAIR_SUB)


@register("t04_pairwise_pvalues", with_ctes(_PAIR_P_SQL))
def t04p(spark, d):
    """Pairwise tests with p-values and the Bonferroni flag."""
    r = I.pairwise_ttests(proc(spark, d), "area_normalized", Y, K.MAJOR_CITIES)
    return r.select("group_1", "group_2", rnd("mean_diff").alias("mean_diff"), rnd("t_stat", 6).alias("t_stat"), "df",
                    rnd("p_value", 6).alias("p_value"), "significant")


@register("t05_ttest2", with_ctes(
    f"WITH m AS (SELECT {REMOTE_SQL} AS f, count(*) AS n, avg(salary_monthly_kzt) AS mean, var_samp(salary_monthly_kzt) AS var "
    f"FROM processed WHERE salary_monthly_kzt IS NOT NULL AND area_normalized IN {MAJOR_SQL} GROUP BY 1), "
    "s AS (SELECT max(CASE WHEN f THEN n END) AS n_t, max(CASE WHEN f THEN mean END) AS m_t, max(CASE WHEN f THEN var END) AS v_t, "
    "max(CASE WHEN NOT f THEN n END) AS n_f, max(CASE WHEN NOT f THEN mean END) AS m_f, max(CASE WHEN NOT f THEN var END) AS v_f FROM m) "
    "SELECT CAST(coalesce(n_t, 0) AS BIGINT) AS n_true, CAST(coalesce(n_f, 0) AS BIGINT) AS n_false, "
    "CASE WHEN n_t >= 30 AND n_f >= 30 THEN round(m_t - m_f, 2) END AS mean_diff, "
    "CASE WHEN n_t >= 30 AND n_f >= 30 THEN round((m_t - m_f) / sqrt(((n_t - 1) * v_t + (n_f - 1) * v_f) / (n_t + n_f - 2) "
    "* (1.0 / n_t + 1.0 / n_f)), 6) END AS t_stat, CASE WHEN n_t >= 30 AND n_f >= 30 THEN CAST(n_t + n_f - 2 AS DOUBLE) END AS df FROM s"))
def t05(spark, d):
    m = major(spark, d).withColumn("is_remote", S.flag_regex("schedule"))
    r = I.ttest2(m, "is_remote", Y)
    return r.select("n_true", "n_false", rnd("mean_diff").alias("mean_diff"), rnd("t_stat", 6).alias("t_stat"), "df")


@register("t06_pearson", with_ctes(
    "SELECT round(r, 6) AS r, n, round(r * sqrt((n - 2) / (1 - r * r)), 6) AS t_stat FROM ("
    "SELECT corr(experience_level, salary_monthly_kzt) AS r, count(salary_monthly_kzt) AS n FROM processed "
    "WHERE salary_monthly_kzt IS NOT NULL)"))
def t06(spark, d):
    r = I.pearson_test(proc(spark, d).withColumn("experience_level", F.col("experience_level").cast("double")),
                       "experience_level", Y)
    return r.select(rnd("r", 6).alias("r"), "n", rnd("t_stat", 6).alias("t_stat"))


_ITEMCORR_SQL = """
WITH r AS (SELECT vacancy_id, salary_monthly_kzt AS y FROM processed WHERE salary_monthly_kzt IS NOT NULL),
t AS (SELECT count(*) AS n_all, sum(y) AS s_all, sum(y * y) AS ss_all FROM r),
per AS (SELECT skill, count(*) AS n_with, sum(y) AS s_with FROM posting_skill JOIN r USING (vacancy_id) GROUP BY skill),
x AS (SELECT skill, s_with / n_with AS m1, (s_all - s_with) / (n_all - n_with) AS m0, n_with, n_all,
        sqrt(ss_all / n_all - (s_all / n_all) * (s_all / n_all)) AS sd, n_with / n_all AS p
      FROM per CROSS JOIN t WHERE n_with > 10 AND n_all - n_with > 10),
c AS (SELECT skill, n_all, (m1 - m0) / sd * sqrt(p * (1 - p)) AS r FROM x),
tt AS (SELECT skill, r, n_all, r * sqrt((n_all - 2) / (1 - r * r)) AS t FROM c),
pv AS (SELECT skill, r, t, """ + t_p_sql("t", "(n_all - 2)") + """ AS p FROM tt)
SELECT skill, round(r, 6) AS correlation, round(t, 6) AS t_stat, round(p, 6) AS p_value,
  CASE WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**' WHEN p < 0.05 THEN '*' ELSE '' END AS stars FROM pv"""


@register("t07_item_correlation", with_ctes(_ITEMCORR_SQL))
def t07(spark, d):
    r = SK.item_premium(skill_sums(spark, d), top=None)
    return r.select("skill", rnd("correlation", 6).alias("correlation"), rnd("t_stat", 6).alias("t_stat"),
                    rnd("p_value", 6).alias("p_value"), "stars")


def _corr_vectors(spark, d, k_items=20):
    """(vector of salary, level, top-k indicators) per posting, the names of
    its positions and their number, which is smaller if there are fewer
    skills."""
    p = skill_rows(spark, d)
    top = SK.top_of(skill_sums(spark, d), k_items)
    labels = [f"skill_{r['skill']}" for r in top.orderBy("rank").collect()]
    vec = SK.hot_array(p, top, "_hot").select(
        F.concat(F.array(F.col(Y).cast("double"), F.col("experience_level").cast("double")), "_hot").alias("v"))
    labels = [Y, "experience_level", *labels]
    names = spark.createDataFrame(list(enumerate(labels, 1)), "pos int, name string")
    return vec, names, len(labels)


_CORR_SQL = f"""
WITH top AS (SELECT skill, row_number() OVER (ORDER BY n DESC, skill) AS rk FROM (
    SELECT skill, count(DISTINCT vacancy_id) AS n FROM posting_skill GROUP BY skill ORDER BY n DESC, skill LIMIT 20)),
v AS (SELECT vacancy_id, 'salary_monthly_kzt' AS name, 1 AS pos, salary_monthly_kzt AS x FROM processed
  UNION ALL SELECT vacancy_id, 'experience_level', 2, CAST(experience_level AS DOUBLE) FROM processed
  UNION ALL SELECT p.vacancy_id, 'skill_' || t.skill, 2 + t.rk,
    CASE WHEN EXISTS (SELECT 1 FROM posting_skill ps WHERE ps.vacancy_id = p.vacancy_id AND ps.skill = t.skill) THEN 1.0 ELSE 0.0 END
  FROM processed p CROSS JOIN top t),
pairs AS (SELECT a.name AS var_1, b.name AS var_2, a.x AS x1, b.x AS x2 FROM v a JOIN v b ON a.vacancy_id = b.vacancy_id AND a.pos < b.pos)
SELECT var_1, var_2, round(corr(x1, x2), 6) AS r FROM pairs GROUP BY var_1, var_2"""


@register("t08_correlation_matrix", with_ctes(_CORR_SQL.replace("round(corr(x1, x2), 6)", "round(CASE WHEN stddev_samp(x1) > 0 AND stddev_samp(x2) > 0 THEN corr(x1, x2) END, 6)")))
def t08(spark, d):
    vec, names, k = _corr_vectors(spark, d)
    r = I.correlation_pairs(vec, "v", k, names)
    return r.select("var_1", "var_2", rnd("r", 6).alias("r"))


@register("t08_top_correlations", with_ctes(
    _CORR_SQL.replace("SELECT var_1, var_2, round(corr(x1, x2), 6) AS r FROM pairs GROUP BY var_1, var_2",
                      "SELECT var_2 AS variable, round(corr(x1, x2), 6) AS r FROM pairs WHERE var_1 = 'salary_monthly_kzt' "
                      "GROUP BY var_2 HAVING stddev_samp(x2) > 0 ORDER BY r DESC, variable LIMIT 10")))
def t08b(spark, d):
    vec, names, k = _corr_vectors(spark, d)
    r = I.correlation_pairs(vec, "v", k, names).where((F.col("var_1") == Y) & F.col("r").isNotNull())
    return r.select(F.col("var_2").alias("variable"), rnd("r", 6).alias("r")).orderBy(F.desc("r"), "variable").limit(10)


@register("t09_linear_trend", with_ctes(
    "SELECT round(regr_slope(salary_monthly_kzt, experience_level), 4) AS slope, "
    "round(regr_intercept(salary_monthly_kzt, experience_level), 4) AS intercept FROM processed WHERE salary_monthly_kzt IS NOT NULL"))
def t09(spark, d):
    p = proc(spark, d).where(F.col(Y).isNotNull()).withColumn("experience_level", F.col("experience_level").cast("double"))
    r = I.linear_trend(p, "experience_level", Y)
    return r.select(rnd("slope", 4).alias("slope"), rnd("intercept", 4).alias("intercept"))


_LEVENE_SRC = (f"(SELECT s.g, abs(s.y - m.med) AS y FROM {_Y} s JOIN (SELECT g, quantile_cont(y, 0.5) AS med FROM {_Y} GROUP BY g) m "
               f"USING (g) WHERE s.g IN {MAJOR_SQL})")
_T10_SQL = (
    "WITH an AS (" + _anova_sql(_Y, None) + "), lv AS (" + _anova_sql(_LEVENE_SRC, None) + "), "
    f"rm AS (SELECT {REMOTE_SQL} AS f, count(*) AS n, avg(salary_monthly_kzt) AS mean, var_samp(salary_monthly_kzt) AS var FROM processed "
    f"WHERE salary_monthly_kzt IS NOT NULL AND area_normalized IN {MAJOR_SQL} GROUP BY 1), "
    "rt AS (SELECT (a.mean - b.mean) / sqrt(((a.n - 1) * a.var + (b.n - 1) * b.var) / (a.n + b.n - 2) * (1.0 / a.n + 1.0 / b.n)) AS t, "
    "a.n + b.n - 2 AS df FROM rm a JOIN rm b ON a.f AND NOT b.f WHERE a.n >= 30 AND b.n >= 30), "
    "pe AS (SELECT r * sqrt((n - 2) / (1 - r * r)) AS t, n - 2 AS df FROM (SELECT corr(experience_level, salary_monthly_kzt) AS r, "
    "count(*) AS n FROM processed WHERE salary_monthly_kzt IS NOT NULL)), "
    "jm AS (SELECT count(*) AS n, avg(pow(x - mu, 2)) AS m2, avg(pow(x - mu, 3)) AS m3, avg(pow(x - mu, 4)) AS m4 FROM "
    "(SELECT salary_monthly_kzt AS x, avg(salary_monthly_kzt) OVER () AS mu FROM processed WHERE salary_monthly_kzt IS NOT NULL)), "
    "jb AS (SELECT n / 6.0 * (pow(m3 / pow(m2, 1.5), 2) + pow(m4 / (m2 * m2) - 3, 2) / 4.0) AS s FROM jm) "
    f"SELECT 'anova' AS test, round(f_stat, 4) AS statistic, round({f_p_sql('f_stat', 'df_between', 'df_within')}, 6) AS p_value FROM an "
    f"UNION ALL SELECT 'levene', round(f_stat, 4), round({f_p_sql('f_stat', 'df_between', 'df_within')}, 6) FROM lv "
    f"UNION ALL SELECT 'remote_ttest', round(max(t), 4), round(max({t_p_sql('t', 'df')}), 6) FROM rt "
    f"UNION ALL SELECT 'pearson', round(t, 4), round({t_p_sql('t', 'df')}, 6) FROM pe "
    "UNION ALL SELECT 'jarque_bera', round(s, 4), round(exp(-s / 2), 6) FROM jb")


@register("t10_test_pvalues", with_ctes(_T10_SQL))
def t10(spark, d):
    """Every test of the regional / EDA study with its p-value: ANOVA,
    Levene, remote t-test, Pearson, Jarque-Bera."""
    p = proc(spark, d)
    m = major(spark, d).withColumn("is_remote", S.flag_regex("schedule"))
    a = I.anova(p, "area_normalized", Y).select(F.lit("anova").alias("test"), F.col("f_stat").alias("statistic"), "p_value")
    lv = I.levene(m, "area_normalized", Y).select(F.lit("levene").alias("test"), F.col("w_stat").alias("statistic"), "p_value")
    t = I.ttest2(m, "is_remote", Y).select(F.lit("remote_ttest").alias("test"), F.col("t_stat").alias("statistic"), "p_value")
    r = I.pearson_test(p.withColumn("experience_level", F.col("experience_level").cast("double")), "experience_level", Y) \
        .select(F.lit("pearson").alias("test"), F.col("t_stat").alias("statistic"), "p_value")
    jb = I.jarque_bera(p, Y).select(F.lit("jarque_bera").alias("test"), F.col("jb_stat").alias("statistic"), "p_value")
    u = a.unionByName(lv).unionByName(t).unionByName(r).unionByName(jb)
    return u.select("test", rnd("statistic", 4).alias("statistic"), rnd("p_value", 6).alias("p_value"))
