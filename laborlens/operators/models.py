"""Valuation models, imputation, clustering and projection.

Features are assembled without wide columns: the top-N skills of each
posting are a 0/1 array made in its own row, then ``array_to_vector``; area
is one-hot with the alphabetically first level dropped.  Models are MLlib
estimators; metrics are SQL aggregates.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..session import stage
from . import gram as G


def in_parallel(fn, items: Sequence, threads: int = 8) -> list:
    """``fn`` of every item, several at a time: independent fits share the
    cluster instead of waiting for each other's last task.  ``fn`` may call
    this again: a thread without an active session takes the default one."""
    from multiprocessing.pool import ThreadPool

    from pyspark import inheritable_thread_target
    from pyspark.sql import SparkSession

    session = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    with ThreadPool(min(threads, max(1, len(items)))) as pool:
        return pool.map(inheritable_thread_target(session)(fn), items)


def hash_split(df: DataFrame, key: str, train_fraction: float = K.TRAIN_FRACTION, seed: int = K.SPLIT_SEED) -> DataFrame:
    """M1: ``is_train`` from a seeded hash of the key: the same split under
    any partitioning or re-execution (unlike ``randomSplit``)."""
    digits = F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), 1, 8)
    return df.withColumn("is_train", F.conv(digits, 16, 10).cast("bigint") % 100 < int(round(train_fraction * 100)))


def levels_of(df: DataFrame, col: str, most: int = 1000) -> list[str]:
    """The distinct values of a category column, last in the alphabet first;
    more than ``most`` is an error, as they become columns of a model."""
    got = [r[0] for r in df.where(F.col(col).isNotNull()).select(col).distinct().limit(most + 1).collect()]
    if len(got) > most:
        raise ValueError(f"{col} has more than {most} levels")
    return sorted(got, reverse=True)


def encode_onehot(df: DataFrame, col: str, levels: Sequence[str], out: str = "area_vec") -> DataFrame:
    """A 0/1 array over ``levels`` without the last, the base level.
    The base level, a null and any level not seen when the levels were taken
    are all zeros."""
    return df.withColumn(out, F.array(*[F.coalesce((F.col(col) == v).cast("double"), F.lit(0.0)) for v in levels[:-1]])
                         .cast("array<double>"))


def assemble(df: DataFrame, arrays: Sequence, out: str = "features") -> DataFrame:
    """The feature vector: numeric arrays, one after another."""
    from pyspark.ml.functions import array_to_vector

    return df.withColumn(out, array_to_vector(F.concat(*arrays)))


def marks(rows: DataFrame, items: Sequence[str], arr: str, out: str = "features") -> DataFrame:
    """``rows`` with the 0/1 marks of ``items`` as a sparse vector: a counting
    vectorizer over the given list."""
    from pyspark.ml.feature import CountVectorizerModel

    v = rows.withColumn("_items", F.coalesce(F.col(arr), F.array().cast("array<string>")))
    m = CountVectorizerModel.from_vocabulary(list(items), inputCol="_items", outputCol=out, minTF=1.0)
    return m.setBinary(True).transform(v).drop("_items")


def sparse_features(rows: DataFrame, items: Sequence[str], arr: str, level: str, category: str, levels: Sequence[str],
                    out: str = "features") -> DataFrame:
    """``rows`` with the feature vector of M2-M5: marks of ``items`` (a
    counting vectorizer over the given list), the number ``level`` and the
    one-hot ``category`` without its base level.  A vector is stored sparse
    where that takes less: a posting has a few of the items."""
    from pyspark.ml.feature import VectorAssembler, VectorSizeHint
    from pyspark.ml.functions import array_to_vector

    v, parts = rows.withColumn("_level", F.col(level).cast("double")), ["_level"]
    if items:
        v, parts = marks(v, items, arr, "_marks"), ["_marks", "_level"]
    if len(levels) > 1:
        v, parts = encode_onehot(v, category, levels, "_area").withColumn("_area", array_to_vector("_area")), [*parts, "_area"]
        v = VectorSizeHint(inputCol="_area", size=len(levels) - 1).transform(v)
    v = VectorAssembler(inputCols=parts, outputCol=out, handleInvalid="keep").transform(v)
    return v.drop("_marks", "_level", "_area")


def label_scale(train: DataFrame, label: str, ddof: int = 0):
    """(n, sd) of the label on the training rows: a one-row summary."""
    sd = F.stddev_pop(label) if ddof == 0 else F.stddev_samp(label)
    r = train.agg(F.count(label).alias("n"), sd.alias("sd")).first()
    return int(r["n"]), float(r["sd"] or 0.0)


def fit_ridge(train: DataFrame, label: str, alpha: float = K.RIDGE_ALPHA, features: str = "features"):
    """M2: ridge with free intercept, unscaled features.  MLlib's L2 term is
    ``regParam/2 * ||w||^2`` on a loss divided by n and by the label's sd, so
    the sklearn-style alpha maps to ``alpha * sd_y / n`` (normal solver,
    population sd)."""
    from pyspark.ml.regression import LinearRegression

    n, sd = label_scale(train, label, ddof=0)
    reg = alpha * sd / max(n, 1)
    lr = LinearRegression(featuresCol=features, labelCol=label, regParam=reg, elasticNetParam=0.0,
                          standardization=False, solver="normal", fitIntercept=True)
    return lr.fit(train)


def fit_lasso(train: DataFrame, label: str, alpha: float = K.LASSO_ALPHA, features: str = "features"):
    """M3: L1 penalty, unscaled features."""
    from pyspark.ml.regression import LinearRegression

    lr = LinearRegression(featuresCol=features, labelCol=label, regParam=alpha, elasticNetParam=1.0,
                          standardization=False, fitIntercept=True, maxIter=200)
    return lr.fit(train)


def fit_forest(train: DataFrame, label: str, trees: int = K.FOREST_TREES, max_depth: int = 30,
               features: str = "features", seed: int = K.SPLIT_SEED, rows: DataFrame | None = None):
    """M4: 100 trees, all features per split, depth capped at MLlib's 30.  It
    predicts the feature vectors of ``train`` and ``rows``."""
    from . import forest

    return forest.fit(train, label, rows, trees, max_depth, features, seed)


def per_vector(train: DataFrame, label: str, features: str = "features") -> DataFrame:
    """A row per feature vector: mean label and number of rows.  A squared
    loss with this weight has the same splits and leaf means as the rows."""
    return train.where(F.col(label).isNotNull()).groupBy(features).agg(
        F.avg(label).alias(label), F.count(F.lit(1)).cast("double").alias("_rows"))


def fit_gbt(train: DataFrame, label: str, rounds: int = K.GBT_ROUNDS, step: float = K.GBT_STEP,
            depth: int = K.GBT_DEPTH, features: str = "features", seed: int = K.SPLIT_SEED, rows: DataFrame | None = None):
    """M5: gradient boosting, squared loss.  It predicts the feature vectors
    of ``train`` and ``rows``."""
    from pyspark.ml.regression import GBTRegressor

    from . import forest

    vectors = stage(per_vector(train, label, features), "vectors")
    model = forest.boost(vectors, label, "_rows", rows, rounds, step, depth, features)
    if model is None:
        gbt = GBTRegressor(featuresCol=features, labelCol=label, weightCol="_rows", maxIter=rounds, stepSize=step, maxDepth=depth, seed=seed)
        fitted = gbt.fit(sized(vectors))
        scores = stage(fitted.transform(forest.asked(vectors, rows, features)).select(features, "prediction"), "forest-scores")
        model = forest.Forest(scores, fitted.featureImportances.toArray(), features)
    return model


def metric_columns(y: str, yhat: str, where=None) -> list:
    """M6: the aggregates rmse, mae and r2 of the rows ``where`` (None: all)."""
    y, e = F.col(y), F.col(y) - F.col(yhat)
    if where is not None:
        y, e = F.when(where, y), F.when(where, e)
    return [F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
            (F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(y))).alias("r2")]


def regression_metrics(pred: DataFrame, y: str, yhat: str = "prediction") -> DataFrame:
    """M6: RMSE, MAE, R^2 as one aggregate."""
    return pred.agg(*metric_columns(y, yhat))


def attach_predictions(rows: DataFrame, predictions: DataFrame, y: str, key: str = "vacancy_id") -> DataFrame:
    """The observed value where there is one, else the prediction; rows
    without either stay, with null."""
    j = rows.select(key, y).join(predictions.select(key, "prediction"), key, "left")
    return j.select(key, F.coalesce(y, "prediction").alias("salary_imputed"), F.col(y).isNull().alias("is_imputed"))


def contiguous_folds(df: DataFrame, key: str, k: int = K.CV_FOLDS) -> DataFrame:
    """Fold id 0..k-1 by key order, contiguous like an unshuffled K-fold
    (the first n % k folds one row larger).  Ranks come from the
    range-partitioned ranking, so no single task sees all rows."""
    from .quantiles import rank_within

    r = rank_within(df, [], key)
    q = F.floor(F.col("_n") / k)
    extra = F.col("_n") - q * k
    big = extra * (q + 1)
    fold = F.when(F.col("_rank") < big, F.floor(F.col("_rank") / (q + 1))).otherwise(
        extra + F.floor((F.col("_rank") - big) / q))
    return r.withColumn("fold", fold.cast("int")).drop("_rank", "_n")


def linear_fold_scores(folded: DataFrame, label: str, k: int, names: Sequence[str] = ("ridge", "lasso"),
                       features: str = "features") -> list[tuple]:
    """(model, fold, r2) of the linear models without a fit per fold: one
    pass gives each fold's sums of products; a fold's training rows are the
    total minus its own, and its R^2 follows from its own sums."""
    import numpy as np
    from pyspark.ml.functions import vector_to_array

    first = folded.select(features).first()
    if first is None:
        return [(name, f, None) for name in names for f in range(k)]
    p = first[0].size
    row = F.concat(F.array(F.lit(1.0)), vector_to_array(features), F.array(F.col(label).cast("double")))
    by = G.gram(folded.where(F.col(label).isNotNull()).select("fold", row.alias("x")), "x", p + 2, by="fold")
    total = sum(by.values(), np.zeros((p + 2, p + 2)))
    solve = {"ridge": lambda g: G.ridge(g, K.RIDGE_ALPHA), "lasso": lambda g: G.lasso(g, K.LASSO_ALPHA)}
    rows = []
    for f in range(k):
        own = by.get(f, np.zeros_like(total))
        train = total - own
        rows += [(name, f, G.r2(own, *solve[name](train)) if train[0, 0] > 0 else None) for name in names]
    return rows


def fold_score(folded: DataFrame, label: str, fold: int, fit) -> float | None:
    """R^2 on one fold of a model fitted on the others."""
    model = fit(folded.where(F.col("fold") != fold), label)
    r2 = regression_metrics(model.transform(folded.where(F.col("fold") == fold)), label).first()["r2"]
    return None if r2 is None else float(r2)


def sized(df: DataFrame, rows_per_task: int = 25_000) -> DataFrame:
    """``df`` in as many partitions as its rows fill, up to 16 a core.  A
    tree is grown by a job per level over all partitions, so a small table in
    many of them waits for its tasks, and the driver gets a result of each."""
    n = min(max(1, -(-df.count() // rows_per_task)), 16 * df.sparkSession.sparkContext.defaultParallelism)
    now = df.rdd.getNumPartitions()
    return df.coalesce(n) if n < now else df.repartition(n) if n > now else df


def cross_validate(df: DataFrame, label: str, linear: Sequence[str] = ("ridge", "lasso"), trees: dict | None = None,
                   k: int = K.CV_FOLDS, key: str = "vacancy_id", kept=None, threads: int = 4) -> DataFrame:
    """M7: per model the R^2 of each fold, trained on the other folds: their
    mean, population sd and number.

    Linear models are solved from fold sums; ``trees`` (name -> fit) are
    fitted several at a time on one frame.  ``kept(name, fold, score)`` may
    keep a score under a name as soon as it is there and give it back later,
    so a run that was stopped goes on where it was."""
    folded = sized(contiguous_folds(df, key, k)).persist()
    keep = kept or (lambda name, fold, score: score())
    trees = trees or {}

    def score(job: tuple) -> tuple:
        name, f = job
        return name, f, keep(name, f, lambda: fold_score(folded, label, f, trees[name]))

    rows = linear_fold_scores(folded, label, k, linear)
    rows += in_parallel(score, [(name, f) for name in trees for f in range(k)], threads)
    folded.unpersist()
    r = df.sparkSession.createDataFrame(rows, "model string, fold int, r2 double")
    return r.groupBy("model").agg(F.avg("r2").alias("cv_mean"), F.stddev_pop("r2").alias("cv_std"), F.count("r2").alias("folds"))


def coefficients(model, names: DataFrame, spark) -> DataFrame:
    """M9: coefficient per feature name (position-aligned with ``names``
    (pos 0-based, name))."""
    coef = [(i, float(c)) for i, c in enumerate(model.coefficients.toArray())]
    c = spark.createDataFrame(coef, "pos int, coefficient double")
    return names.join(c, "pos")


def importances(model, names: DataFrame, spark) -> DataFrame:
    """M10."""
    imp = [(i, float(c)) for i, c in enumerate(model.featureImportances.toArray())]
    return names.join(spark.createDataFrame(imp, "pos int, importance double"), "pos")


def counted_vectors(df: DataFrame, features: str = "features") -> DataFrame:
    """A row per feature vector with its number of rows, ``_rows``.  With
    this weight the cost of any centres is that of the rows."""
    return sized(stage(df.groupBy(features).agg(F.count(F.lit(1)).cast("double").alias("_rows")), "vectors"))


def kmeans_points(df: DataFrame, features: str = "features") -> tuple[DataFrame, str | None]:
    """What k-means reads for the rows ``df``, and its weight: the counted
    vectors where they are at most half as many, else the rows (None)."""
    vectors = counted_vectors(df, features)
    return (vectors, "_rows") if 2 * vectors.count() <= df.count() else (df, None)


def kmeans_fit(df: DataFrame, k: int, features: str = "features", seed: int = K.SPLIT_SEED,
               n_init: int = K.KMEANS_STARTS, weight: str | None = None):
    """Best of ``n_init`` seeded k-means runs by training cost; ``weight``:
    the column with the number of rows that a vector stands for."""
    from pyspark.ml.clustering import KMeans

    more = {"weightCol": weight} if weight else {}
    fits = in_parallel(lambda i: KMeans(k=k, seed=seed + i, featuresCol=features, **more).fit(df), range(n_init))
    return min(fits, key=lambda m: m.summary.trainingCost)


def relabel_by_size(pred: DataFrame, col: str = "prediction") -> DataFrame:
    """Stable cluster ids: 0 = largest cluster (ties by old id)."""
    sizes = pred.groupBy(col).agg(F.count(F.lit(1)).alias("_size"))
    sizes = sizes.withColumn("cluster", (F.row_number().over(Window.orderBy(F.desc("_size"), F.asc(col))) - 1).cast("int"))
    return pred.join(F.broadcast(sizes.select(col, "cluster")), col).drop(col)


def pca2(df: DataFrame, features: str = "features"):
    """Centred PCA to 2 components; returns (model, projected frame)."""
    from pyspark.ml.feature import PCA, StandardScaler

    sc = StandardScaler(inputCol=features, outputCol="_centred", withMean=True, withStd=False).fit(df)
    c = sc.transform(df)
    model = PCA(k=2, inputCol="_centred", outputCol="pca").fit(c)
    return model, model.transform(c).drop("_centred")
