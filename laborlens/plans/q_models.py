"""Queries: models, imputation, clustering, PCA.

Within a query the feature frame is written once as a stage table, and a
model is fitted once.  Fitted models are saved in the shared folder under a
digest of the rows that they were fitted on, so another query over the same
rows loads them, and changed data never meets an old model.
"""
from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import scalar as S
from ..operators import aggregates as A
from ..operators import clusters
from ..operators import models as M
from ..operators import skills as SK
from ..operators.forest import Forest
from ..session import checkpoint_root, stage
from . import preprocess as PP
from .build import build_cache
from .catalog import register, rnd, with_ctes
from .q_stats import Y, skill_rows, skill_sums

#: Part of the kept results' paths; another tag makes queries fit anew.
KEEP_TAG = "kept"

#: Up to so many rows k-means is MLlib's.
FEW_ROWS = 100_000

FITS = {"ridge": M.fit_ridge, "lasso": M.fit_lasso, "forest": M.fit_forest, "gbt": M.fit_gbt}


def _once(key, build):
    """Build a thing once per query build."""
    cache = build_cache()
    if cache is None:
        return build()
    if key not in cache:
        cache[key] = build()
    return cache[key]


def _top(spark, d):
    return SK.top_of(skill_sums(spark, d), K.TOP_N_SKILLS)


def feature_names(top_skills, levels):
    """Names by position, from the real numbers of skills and levels."""
    return [f"skill_{s}" for s in top_skills] + ["experience_level"] + [f"area_normalized_{v}" for v in levels[:-1]]


def features_of(rows, top, levels):
    """``rows`` with ``features``: the top skills' 0/1 marks, the level and
    the area, as a sparse vector where that is the shorter one."""
    names = [r["skill"] for r in top.orderBy("rank").collect()]
    return M.sparse_features(rows, names, SK.ARR, "experience_level", "area_normalized", levels)


def feature_frame(spark, d):
    """(rows with features and split, names (pos, name) of the positions)."""
    def build():
        rows = skill_rows(spark, d, extra=("name",))
        top = _top(spark, d)
        levels = M.levels_of(rows, "area_normalized")
        f = features_of(rows.select("vacancy_id", "name", Y, "experience_level", "area_normalized", SK.ARR), top, levels)
        f = stage(M.hash_split(f.drop(SK.ARR), "vacancy_id"), "features")
        labels = feature_names([r["skill"] for r in top.orderBy("rank").collect()], levels)
        return f, spark.createDataFrame(list(enumerate(labels)), "pos int, name string")
    return _once(("features", d), build)


def _digest(df):
    cols = [vector_to_array(c).alias(c) if t == "vector" else F.col(c) for c, t in df.dtypes]
    r = df.select(F.xxhash64(*cols).alias("h")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s")).first()
    return f"{r['n']}-{r['s']}".replace("--", "-m")


def _kept(spark, name, rows):
    """Where the result ``name`` of fitting on ``rows`` is kept."""
    return f"{checkpoint_root(spark).rstrip('/')}/laborlens/models/{spark.sparkContext.applicationId}-{KEEP_TAG}/{name}-{_digest(rows)}"


def _exists(spark, path):
    """Whether a write to ``path`` has been committed."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    done = [jvm.org.apache.hadoop.fs.Path(f"{path}/{x}") for x in ("_SUCCESS", "data/_SUCCESS")]
    return any(p.getFileSystem(conf).exists(p) for p in done)


def _fitted(spark, name, rows, fit, kind):
    """A model fitted on ``rows``, or the saved one of equal rows."""
    path = _kept(spark, name, rows)
    if _exists(spark, path):
        return kind.load(path)
    model = fit(rows)
    model.write().overwrite().save(path)
    return model


def _model(spark, d, name):
    from pyspark.ml import regression as R

    def build():
        f, _ = feature_frame(spark, d)
        train = f.where(F.col("is_train") & F.col(Y).isNotNull()).select("vacancy_id", Y, "features")
        if name in ("forest", "gbt"):
            return _scored(spark, d, name, train, f)
        return _fitted(spark, name, train, lambda t: FITS[name](t, Y), R.LinearRegressionModel)
    return _once(("model", name, d), build)


def _scored(spark, d, name, train, rows):
    """The trees of ``train`` with predictions for ``rows``, or the saved ones
    of equal rows."""
    path = f"{_kept(spark, name, train)}-{_once(('asked', d), lambda: _digest(rows.select('features')))}"
    if not _exists(spark, path):
        FITS[name](train, Y, rows=rows).save(path)
    return Forest.load(spark, path)


@register("m01_split", with_ctes(
    f"SELECT CAST('0x' || substr(md5(vacancy_id || ':{K.SPLIT_SEED}'), 1, 8) AS BIGINT) % 100 < {round(K.TRAIN_FRACTION * 100)} AS is_train, "
    "count(*) AS n FROM processed WHERE salary_monthly_kzt IS NOT NULL GROUP BY 1"))
def m01(spark, d):
    rows = M.hash_split(skill_rows(spark, d), "vacancy_id")
    return rows.where(F.col(Y).isNotNull()).groupBy("is_train").agg(F.count(F.lit(1)).alias("n"))


@register("c23_encode_onehot", with_ctes(
    "WITH l AS (SELECT list(DISTINCT area_normalized ORDER BY area_normalized DESC)[:-2] AS ls FROM processed0) "
    "SELECT vacancy_id, area_normalized, array_to_string(list_transform(ls, lambda x: CASE WHEN area_normalized = x THEN '1.0' "
    "ELSE '0.0' END), '|') AS area_onehot FROM processed0 CROSS JOIN l"))
def c23(spark, d):
    p = skill_rows(spark, d, salary=False)
    v = M.encode_onehot(p, "area_normalized", M.levels_of(p, "area_normalized"))
    return v.select("vacancy_id", "area_normalized", F.array_join(F.col("area_vec").cast("array<string>"), "|").alias("area_onehot"))


def _premiums(spark, d):
    f, names = feature_frame(spark, d)
    c = M.coefficients(_model(spark, d, "ridge"), names, spark)
    return c.where(F.col("name").startswith("skill_")).select(
        S.title_label("name").alias("skill"), F.col("coefficient").alias("premium"))


@register("m02_ridge_premiums")
def m02(spark, d):
    """M2 + M9: skill premium = ridge coefficient with other features held."""
    return _premiums(spark, d).orderBy(F.desc("premium"), "skill")


@register("m03_lasso_coefficients")
def m03(spark, d):
    _, names = feature_frame(spark, d)
    return M.coefficients(_model(spark, d, "lasso"), names, spark).orderBy("pos")


@register("m04_forest_importance")
def m04(spark, d):
    """M4 + M10."""
    _, names = feature_frame(spark, d)
    return M.importances(_model(spark, d, "forest"), names, spark).orderBy(F.desc("importance"), "name")


def _metrics(spark, d, names):
    """M6 of the models, from one pass over the rows with all predictions."""
    f, _ = feature_frame(spark, d)
    pred = f.where(F.col(Y).isNotNull())
    for name in names:
        pred = _model(spark, d, name).transform(pred).withColumnRenamed("prediction", f"_{name}")
    parts = {"train": F.col("is_train"), "test": ~F.col("is_train")}
    one = pred.agg(*[F.struct(*[c.alias(f"{part}_{m}") for part, rows in parts.items()
                                for m, c in zip(("rmse", "mae", "r2"), M.metric_columns(Y, f"_{name}", rows), strict=True)]).alias(f"_{name}")
                     for name in names])
    return one.select(F.inline(F.array(*[F.struct(F.lit(name).alias("model"), f"_{name}.*") for name in names])))


@register("m05_gbt_metrics")
def m05(spark, d):
    return _metrics(spark, d, ["gbt"])


@register("m06_model_metrics")
def m06(spark, d):
    feature_frame(spark, d)
    M.in_parallel(lambda name: _model(spark, d, name), [name for name in FITS if name != "forest"])
    _model(spark, d, "forest")                          # fills the cores and their memory by itself
    return _metrics(spark, d, list(FITS))


def _cross_validated(spark, d):
    """Ridge and lasso from fold sums, ten tree fits; the score of each model
    and fold is kept by the digest of the rows as soon as it is there, like a
    model."""
    def build():
        f, _ = feature_frame(spark, d)
        rows = f.where(F.col(Y).isNotNull()).select("vacancy_id", Y, "features")
        base = _kept(spark, "cv", rows)

        def kept(name, fold, score):
            path = f"{base}/{name}-{fold}"
            if not _exists(spark, path):
                spark.createDataFrame([(score(),)], "r2 double").coalesce(1).write.mode("overwrite").parquet(path)
            return spark.read.schema("r2 double").parquet(path).first()[0]

        trees = {name: lambda t, y, fit=FITS[name]: fit(t, y, rows=rows) for name in ("forest", "gbt")}
        return M.cross_validate(rows, Y, ("ridge", "lasso"), trees, kept=kept)
    return _once(("cv", d), build)


@register("m07_cross_validate")
def m07(spark, d):
    """Five folds for each of the four models."""
    return _cross_validated(spark, d)


@register("m08_compare_models")
def m08(spark, d):
    """Models by test R^2 with the overfit gap and the cross-validated R^2;
    the first row is the best."""
    feature_frame(spark, d)
    metrics, crossed = M.in_parallel(lambda f: f(spark, d), [m06, _cross_validated])   # their fits share the cluster
    m = metrics.join(crossed.select("model", "cv_mean", "cv_std"), "model")
    return m.select("model", "test_r2", "train_r2", (F.col("train_r2") - F.col("test_r2")).alias("overfit_gap"),
                    "test_rmse", "test_mae", "cv_mean", "cv_std").orderBy(F.desc("test_r2"), "model")


def _imputed(spark, d):
    """0.6 forest + 0.4 boosting for rows without a salary; interval
    +- 1.96 x population sd of the forest's training residuals."""
    f, _ = feature_frame(spark, d)
    rf, gb = _model(spark, d, "forest"), _model(spark, d, "gbt")
    train = f.where(F.col("is_train") & F.col(Y).isNotNull())
    sd = rf.transform(train).agg(F.stddev_pop(F.col(Y) - F.col("prediction")).alias("_sd"))
    p1 = rf.transform(f).withColumnRenamed("prediction", "_rf")
    p2 = gb.transform(p1).withColumnRenamed("prediction", "_gb")
    w1, w2 = K.BLEND_WEIGHTS
    blend = F.lit(w1) * F.col("_rf") + F.lit(w2) * F.col("_gb")
    z = K.INTERVAL_Z
    return p2.crossJoin(F.broadcast(sd)).select(
        "vacancy_id", "name", Y, blend.alias("salary_predicted"),
        (blend - z * F.col("_sd")).alias("salary_lower_95"), (blend + z * F.col("_sd")).alias("salary_upper_95"))


@register("m11_impute_salaries")
def m11(spark, d):
    return _imputed(spark, d).where(F.col(Y).isNull()).select(
        "vacancy_id", "name", "salary_predicted", "salary_lower_95", "salary_upper_95")


@register("j07_attach_predictions")
def j07(spark, d):
    """Imputed table: observed salary where present, else the blend."""
    i = _imputed(spark, d)
    return M.attach_predictions(i.select("vacancy_id", Y), i.select("vacancy_id", F.col("salary_predicted").alias("prediction")), Y)


@register("a22_prediction_summary")
def a22(spark, d):
    p = m11(spark, d)
    r = A.distribution_stats(p, "salary_predicted")
    return r.select("count", "mean", "median", "min", "max")


def residual_stats(pred, y=Y, yhat="prediction"):
    """Residuals (actual - predicted)."""
    e = F.col(y) - F.col(yhat)
    return pred.where(F.col(y).isNotNull()).agg(F.avg(e).alias("mean_residual"), F.stddev_samp(e).alias("std_residual"),
                                                F.max(e).alias("max_residual"), F.min(e).alias("min_residual"))


@register("m12_residual_stats")
def m12(spark, d):
    """Residuals (actual - predicted) of the best model on the test rows."""
    best = m06(spark, d).orderBy(F.desc("test_r2"), "model").first()["model"]
    f, _ = feature_frame(spark, d)
    pred = _model(spark, d, best).transform(f.where(~F.col("is_train") & F.col(Y).isNotNull()))
    return residual_stats(pred).withColumn("model", F.lit(best))


# Fixed predictions (a formula of the row) let SQL recompute what is made of
# predictions: metrics, residuals, the imputed table and its summary.
_FIXED = "(4e5 + 1.2e5 * experience_level + 1e1 * (vacancy_id % 1000))"


def _fixed(spark, d):
    return skill_rows(spark, d).withColumn("prediction", F.expr(_FIXED))


@register("m06_metrics_fixed_predictions", with_ctes(
    f"SELECT round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae, round(1 - sum(e * e) / (var_pop(y) * count(y)), 6) AS r2 "
    f"FROM (SELECT salary_monthly_kzt AS y, salary_monthly_kzt - {_FIXED} AS e FROM processed WHERE salary_monthly_kzt IS NOT NULL)"))
def m06f(spark, d):
    m = M.regression_metrics(_fixed(spark, d).where(F.col(Y).isNotNull()), Y)
    return m.select(rnd("rmse", 4).alias("rmse"), rnd("mae", 4).alias("mae"), rnd("r2", 6).alias("r2"))


@register("m12_residuals_fixed_predictions", with_ctes(
    "SELECT round(avg(e), 4) AS mean_residual, round(stddev_samp(e), 4) AS std_residual, round(max(e), 4) AS max_residual, "
    f"round(min(e), 4) AS min_residual FROM (SELECT salary_monthly_kzt - {_FIXED} AS e FROM processed WHERE salary_monthly_kzt IS NOT NULL)"))
def m12f(spark, d):
    r = residual_stats(_fixed(spark, d))
    return r.select(*[rnd(c, 4).alias(c) for c in ("mean_residual", "std_residual", "max_residual", "min_residual")])


@register("j07_attach_fixed_predictions", with_ctes(
    f"SELECT vacancy_id, round(coalesce(salary_monthly_kzt, {_FIXED}), 4) AS salary_imputed, salary_monthly_kzt IS NULL AS is_imputed FROM processed"))
def j07f(spark, d):
    p = _fixed(spark, d)
    r = M.attach_predictions(p, p.select("vacancy_id", "prediction"), Y)
    return r.select("vacancy_id", rnd("salary_imputed", 4).alias("salary_imputed"), "is_imputed")


@register("a22_summary_fixed_predictions", with_ctes(
    f"SELECT count(*) AS count, round(avg(x), 2) AS mean, round(quantile_cont(x, 0.5), 2) AS median, round(min(x), 2) AS min, round(max(x), 2) AS max "
    f"FROM (SELECT {_FIXED} AS x FROM processed WHERE salary_monthly_kzt IS NULL)"))
def a22f(spark, d):
    r = A.distribution_stats(_fixed(spark, d).where(F.col(Y).isNull()), "prediction")
    return r.select("count", *[rnd(c).alias(c) for c in ("mean", "median", "min", "max")])


def _cluster_input(spark, d):
    def build():
        rows = skill_rows(spark, d).select("vacancy_id", Y, SK.ARR)
        names = [r["skill"] for r in _top(spark, d).orderBy("rank").collect()]
        return stage(M.marks(rows, names, SK.ARR) if names else M.assemble(rows, [F.array().cast("array<double>")]), "cluster-input")
    return _once(("cluster_input", d), build)


@register("m13_kmeans_sweep")
def m13(spark, d):
    """Cost and silhouette (squared Euclidean) for k = 2..10."""
    v, points, weight, in_tasks = _points(_cluster_input(spark, d).select("features"))
    if in_tasks:
        best = clusters.best_starts(points, K.KMEANS_SWEEP, K.KMEANS_STARTS, K.SPLIT_SEED)
        rows = [(k, *best[k][:2]) for k in K.KMEANS_SWEEP]
    else:
        rows = _sweep(v, points, weight)
    return spark.createDataFrame(rows, "k int, inertia double, silhouette double")


def _points(rows):
    """(rows, points, their weight, whether the starts run in tasks): they do
    over counted points that fit a task.  A table of few rows is short work
    for MLlib and keeps its dense vectors, and with them its centres."""
    if rows.count() <= FEW_ROWS:
        rows = rows.select(array_to_vector(vector_to_array("features")).alias("features"))
        return rows, *M.kmeans_points(rows), False
    points, weight = M.kmeans_points(rows)
    return rows, points, weight, weight is not None and clusters.fits_one_task(points)


def _sweep(v, points, weight):
    """The sweep by MLlib, where the rows are few or the vectors too many."""
    from pyspark.ml.evaluation import ClusteringEvaluator

    v = v.persist()                                     # the silhouette is of the rows
    points = points.persist()

    def one(k):
        m = M.kmeans_fit(points, k, weight=weight)
        return k, float(m.summary.trainingCost), float(ClusteringEvaluator(featuresCol="features").evaluate(m.transform(v)))

    rows = M.in_parallel(one, K.KMEANS_SWEEP, 3)
    points.unpersist()
    v.unpersist()
    return rows


def _clusters(spark, d):
    from pyspark.ml.clustering import KMeansModel

    def build():
        v = _cluster_input(spark, d)

        def fit(rows):
            _, points, weight, in_tasks = _points(rows)
            if in_tasks:
                _, _, centres = clusters.best_starts(points, [K.KMEANS_K], K.KMEANS_STARTS, K.SPLIT_SEED)[K.KMEANS_K]
                return clusters.model_of(spark, centres)
            points = points.persist()                   # one copy that all starts read, not one of each
            best = M.kmeans_fit(points, K.KMEANS_K, weight=weight)
            points.unpersist()
            return best
        km = _fitted(spark, f"kmeans{K.KMEANS_K}", v.select("features"), fit, KMeansModel)
        return M.relabel_by_size(stage(km.transform(v).drop("features"), "clustered"))
    return _once(("clusters", d), build)


@register("m14_cluster")
def m14(spark, d):
    return _clusters(spark, d).select("vacancy_id", "cluster")


def cluster_profile(c, y=Y, k=5):
    """Size, share, mean of ``y`` and the k most frequent skills per cluster."""
    n = c.agg(F.count(F.lit(1)).alias("_n"))
    prof = c.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.avg(y).alias("avg_salary"))
    sk = SK.explode_items(c, "cluster").groupBy("cluster", "skill").agg(F.count(F.lit(1)).alias("n"))
    top = SK.top_k_per_group(sk, ["cluster"], "n", k, "skill")
    names = top.groupBy("cluster").agg(F.sort_array(F.collect_list(F.struct("rank", "skill"))).alias("_t")).select(
        "cluster", S.join_labels(F.transform("_t", lambda x: x["skill"])).alias("top_skills"))
    return prof.crossJoin(F.broadcast(n)).join(names, "cluster", "left").select(
        "cluster", "size", S.pct("size", "_n").alias("share_pct"), "avg_salary", "top_skills")


@register("a13_cluster_profile")
def a13(spark, d):
    return cluster_profile(_clusters(spark, d))


# A fixed assignment (by the order key) lets SQL recompute the cluster tables.
_FIXED_SQL = "(SELECT *, CAST(vacancy_id % 3 AS INT) AS cluster FROM processed)"


@register("a13_profile_fixed_clusters", with_ctes(
    f"WITH c AS {_FIXED_SQL}, k AS (SELECT cluster, skill, row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, skill) AS rank "
    "FROM (SELECT cluster, unnest(skill_slugs) AS skill FROM c) GROUP BY cluster, skill QUALIFY rank <= 5) "
    "SELECT cluster, size, round(100.0 * size / (SELECT count(*) FROM c), 6) AS share_pct, round(avg_salary, 2) AS avg_salary, top_skills "
    "FROM (SELECT cluster, count(*) AS size, avg(salary_monthly_kzt) AS avg_salary FROM c GROUP BY cluster) "
    "JOIN (SELECT cluster, string_agg(skill, ', ' ORDER BY rank) AS top_skills FROM k GROUP BY cluster) USING (cluster)"))
def a13f(spark, d):
    """A13 over a fixed assignment of postings to clusters."""
    c = skill_rows(spark, d).withColumn("cluster", (F.col("vacancy_id") % 3).cast("int"))
    r = cluster_profile(c)
    return r.select("cluster", "size", rnd("share_pct", 6).alias("share_pct"), rnd("avg_salary").alias("avg_salary"), "top_skills")


@register("a14_cluster_indicator_rates")
def a14c(spark, d):
    """A14 by cluster: share of each cluster's postings having each skill."""
    r = SK.indicator_rates(_clusters(spark, d), "cluster")
    return r.select("cluster", "skill", rnd("rate", 6).alias("rate"))


@register("m15_pca")
def m15(spark, d):
    v = _cluster_input(spark, d)
    model, proj = M.pca2(v.select("vacancy_id", "features"))
    ev = [(i + 1, float(x)) for i, x in enumerate(model.explainedVariance.toArray())]
    pts = proj.select(vector_to_array("pca").alias("_p")).agg(F.count(F.lit(1)).alias("n_points"),
                                                                   F.avg(F.col("_p")[0]).alias("mean_pc1"),
                                                                   F.avg(F.col("_p")[1]).alias("mean_pc2"))
    return spark.createDataFrame(ev, "component int, explained_variance_ratio double").crossJoin(pts)
