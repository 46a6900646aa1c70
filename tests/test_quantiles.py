"""Range-partitioned ranks and exact quantiles against NumPy, including a
group that holds most rows, ties, nulls and a one-row group."""
import numpy as np
from pyspark.sql import functions as F

from laborlens.operators.quantiles import ecdf, percentile_of_score, quantiles, rank_within


def _data(spark):
    rng = np.random.default_rng(7)
    rows = [("hot", float(v)) for v in rng.integers(0, 50, 3000)]          # hot group with ties
    rows += [("cold", float(v)) for v in rng.normal(100, 10, 200)]
    rows += [("single", 5.0), ("cold", None), (None, 1.0)]
    return spark.createDataFrame(rows, "g string, y double"), rows


def test_exact_quantiles_match_numpy(spark):
    df, rows = _data(spark)
    got = {r["g"]: r for r in quantiles(df, ["g"], "y", {"q1": 0.25, "med": 0.5, "q3": 0.75}).collect()}
    for g in ("hot", "cold", "single"):
        v = np.array([y for k, y in rows if k == g and y is not None])
        for name, q in (("q1", 0.25), ("med", 0.5), ("q3", 0.75)):
            assert abs(got[g][name] - np.quantile(v, q)) < 1e-9
    assert set(got) == {"hot", "cold", "single"}  # null key dropped


def test_ranks_are_a_permutation_within_groups(spark):
    df, rows = _data(spark)
    r = rank_within(df, ["g"], "y", partitions=7)
    c = r.groupBy("g").agg(F.min("_rank").alias("lo"), F.max("_rank").alias("hi"), F.count("*").alias("n"),
                           F.countDistinct("_rank").alias("d"), F.first("_n").alias("nn")).collect()
    for row in c:
        assert row.lo == 0 and row.hi == row.n - 1 and row.d == row.n == row.nn


def test_ecdf_positions(spark):
    df = spark.createDataFrame([(3.0,), (1.0,), (2.0,), (2.0,)], "y double")
    got = sorted((r.y, r.position) for r in ecdf(df, "y").collect())
    assert [p for _, p in got] == [1, 2, 3, 4]


def test_percentile_of_score_counts_le_and_nulls(spark):
    market = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (3.0,), (None,)], "v double")
    scores = spark.createDataFrame([(1, 2.0), (2, 0.5), (3, 10.0)], "id int, s double")
    got = {r.id: (r.n_le, r.percentile) for r in percentile_of_score(market, "v", scores, "s", ["id"]).collect()}
    assert got == {1: (3, 60.0), 2: (0, 0.0), 3: (4, 80.0)}


def test_approx_switch_runs(spark):
    df, _ = _data(spark)
    got = quantiles(df, ["g"], "y", {"med": 0.5}, approx=True).collect()
    assert {r.g for r in got} == {"hot", "cold", "single"}
