"""Ridge against the NumPy closed form; association rules against brute
force on small baskets; hash split stability."""
from itertools import combinations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from laborlens.operators import models as M
from laborlens.operators import rules as R


def test_ridge_matches_closed_form(spark):
    rng = np.random.default_rng(11)
    n, k = 300, 4
    X = rng.integers(0, 2, (n, k)).astype(float)
    X[:, 3] = rng.integers(0, 4, n)
    y = 500000 + X @ np.array([120000.0, -50000.0, 30000.0, 80000.0]) + rng.normal(0, 40000, n)
    df = spark.createDataFrame([(list(map(float, X[i])), float(y[i])) for i in range(n)], "x array<double>, y double")
    df = df.withColumn("features", array_to_vector("x"))
    model = M.fit_ridge(df, "y", alpha=1.0)
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + 1.0 * np.eye(k), Xc.T @ yc)
    assert np.allclose(model.coefficients.toArray(), w, rtol=1e-6, atol=1e-3)
    assert abs(model.intercept - (y.mean() - X.mean(0) @ w)) < 1e-3 * abs(model.intercept)


def test_rules_brute_force(spark):
    baskets = [["a", "b", "c"], ["a", "b"], ["a", "c"], ["b", "c"], ["a", "b", "c"], [], ["a"], ["a", "b", "c", "d"]]
    df = spark.createDataFrame([(b,) for b in baskets], "items array<string>")
    fi = R.frequent_itemsets(df, "items", 0.25)
    rules = R.association_rules(fi, 0.5).collect()
    n = len(baskets)

    def supp(s):
        return sum(1 for b in baskets if set(s) <= set(b)) / n
    items = sorted({x for b in baskets for x in b})
    frequent = [set(c) for k in range(1, len(items) + 1) for c in combinations(items, k) if supp(c) >= 0.25]
    want = set()
    for x in frequent:
        if len(x) < 2:
            continue
        for k in range(1, len(x)):
            for a in combinations(sorted(x), k):
                conf = supp(x) / supp(a)
                if conf >= 0.5:
                    want.add((a, tuple(sorted(x - set(a))), round(supp(x), 9), round(conf, 9),
                              round(conf / supp(x - set(a)), 9)))
    got = {(tuple(r.antecedents), tuple(r.consequents), round(r.support, 9), round(r.confidence, 9), round(r.lift, 9))
           for r in rules}
    assert got == want
    assert any(len(c) > 1 for _, c, *_ in got)  # multi-item consequents present


def test_hash_split_is_stable_under_repartitioning(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a = M.hash_split(df, "k").where("is_train").select("k")
    b = M.hash_split(df.repartition(13), "k").where("is_train").select("k")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    frac = a.count() / 2000
    assert 0.75 < frac < 0.85


def test_contiguous_folds(spark):
    df = spark.range(23).withColumnRenamed("id", "k")
    f = {r.k: r.fold for r in M.contiguous_folds(df, "k", 5).collect()}
    sizes = [sum(1 for v in f.values() if v == i) for i in range(5)]
    assert sizes == [5, 5, 5, 4, 4]
    assert all(f[i] <= f[i + 1] for i in range(22))


def test_relabel_by_size(spark):
    df = spark.createDataFrame([(1,), (1,), (0,)], "prediction int")
    got = sorted((r.cluster) for r in M.relabel_by_size(df).collect())
    assert got == [0, 0, 1]
    assert F is not None
