"""Forms that stay small where the data grow: selection, sums, masks, level-wise
growth, joins with a dictionary or a path index, streaming state."""
import os
import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laborlens.functions import text as TX
from laborlens.operators import advisor as AD
from laborlens.operators import charts as V
from laborlens.operators import dictionary as DI
from laborlens.operators import forest as FO
from laborlens.operators import gap as G
from laborlens.operators import gram as GR
from laborlens.operators import models as M
from laborlens.operators import quantiles as Q
from laborlens.operators import rules as R
from laborlens.sources import files as FS
from laborlens.streaming.landing import _folders, compact_landed, land_stream, read_landed


def test_quantiles_are_exact_by_selection(spark):
    rng = np.random.default_rng(3)
    groups = {"normal": rng.normal(5e5, 1e5, 9000), "tiny": 1e9 + rng.random(5000) * 1e-3, "ties": rng.integers(-3, 4, 9000) * 1.0,
              "wide": np.concatenate([10.0 ** rng.uniform(-200, 200, 2000), -(10.0 ** rng.uniform(-200, 200, 2000)), [0.0, -0.0]]),
              "one": np.array([4.0]), "hot": np.concatenate([np.full(8000, 7.0), rng.random(1000)])}
    rows = [(g, float(x)) for g, v in groups.items() for x in v] + [("normal", None), (None, 1.0), ("ties", float("nan"))]
    df = spark.createDataFrame(rows, "g string, y double").repartition(7)
    probs = {"a": 0.0, "b": 0.001, "c": 0.25, "d": 0.5, "e": 0.75, "f": 0.999, "z": 1.0}
    for few in (20_000, 2):
        got = {r["g"]: r for r in Q.quantiles(df, ["g"], "y", probs, extra={"n": F.count("y")}, brackets=500, few=few).collect()}
        assert set(got) == set(groups)
        for g, v in groups.items():
            assert got[g]["n"] == len(v)
            for name, q in probs.items():
                assert got[g][name] == pytest.approx(np.quantile(v, q), rel=1e-12, abs=1e-300)
    for n in (1, 2, 3, 5, 40, 1250, 1251):          # fewer rows than the sketch tells apart
        x = rng.normal(size=n)
        r = Q.quantiles(spark.createDataFrame([(float(v),) for v in x], "y double"), [], "y", probs).first()
        assert [r[p] for p in probs] == pytest.approx(list(np.quantile(x, list(probs.values()))), rel=1e-9, abs=1e-12)
    every = np.concatenate([*groups.values(), [1.0]])
    one = Q.quantiles(df, [], "y", probs).first()
    assert [one[p] for p in probs] == pytest.approx(list(np.quantile(every, list(probs.values()))), rel=1e-12)
    assert Q.quantiles(df.where("false"), [], "y", {"m": 0.5}).first()["m"] is None
    assert Q.quantiles(df.where("false"), ["g"], "y", {"m": 0.5}).count() == 0


def test_quantile_plan_neither_ranges_nor_checkpoints(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.col("id") * 1.5).alias("y"))
    plan = Q.quantiles(df, [], "y", {"m": 0.5})._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "ExistingRDD" not in plan


def gram_of(x, y):
    z = np.column_stack([np.ones(len(y)), x, y])
    return z.T @ z


def test_linear_models_from_sums(spark):
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.integers(0, 2, (400, 6)), rng.integers(0, 4, 400)]).astype(float)
    x[:, 5] = 1.0
    y = 5e5 + x @ np.array([9e4, -5e4, 10.0, 3e4, 0.0, 1e4, 8e4]) + rng.normal(0, 3e4, 400)
    df = spark.createDataFrame([(list(map(float, a)), float(b), i % 3) for i, (a, b) in enumerate(zip(x, y, strict=True))],
                               "x array<double>, y double, f int")
    by = GR.gram(df.repartition(5).select(F.concat(F.array(F.lit(1.0)), "x", F.array("y")).alias("v"), "f"), "v", 9, by="f")
    assert np.allclose(sum(by.values()), gram_of(x, y)) and sorted(by) == [0, 1, 2]
    m = M.assemble(df, ["x"])
    w, b = GR.ridge(gram_of(x, y), 1.0)
    ridge = M.fit_ridge(m, "y", alpha=1.0)
    assert np.allclose(w, ridge.coefficients.toArray(), rtol=1e-5, atol=1.0) and b == pytest.approx(ridge.intercept, rel=1e-5)
    for alpha in (100.0, 8000.0):
        w, b = GR.lasso(gram_of(x, y), alpha)
        lasso = M.fit_lasso(m, "y", alpha=alpha)
        assert np.allclose(w, lasso.coefficients.toArray(), rtol=1e-3, atol=30.0)
        assert GR.r2(gram_of(x, y), w, b) == pytest.approx(M.regression_metrics(lasso.transform(m), "y").first()["r2"], abs=1e-5)
    e = y - b - x @ w
    assert GR.r2(gram_of(x, y), w, b) == pytest.approx(1 - (e @ e) / ((y - y.mean()) ** 2).sum())
    assert GR.r2(gram_of(x[:0], y[:0]), w, b) is None and GR.r2(gram_of(x[:5], y[:5] * 0 + 3), w, b) is None
    assert (GR.gram(df.where("false"), "x", 7)[None] == 0).all()


def test_scores_are_kept_as_they_end(spark):
    df = M.assemble(spark.createDataFrame([(i, [float(i % 5), float(i % 2)], float(i % 5) + i % 2) for i in range(50)],
                                          "vacancy_id int, a array<double>, y double"), ["a"])
    done, fits = {}, []

    def fit(train, label):
        fits.append(1)
        return M.fit_ridge(train, label)

    def kept(name, fold, score):
        if fold == 3 and not done.get("again"):
            raise RuntimeError("stopped")
        if (name, fold) not in done:
            done[name, fold] = score()
        return done[name, fold]

    with pytest.raises(RuntimeError):
        M.cross_validate(df, "y", (), {"tree": fit}, kept=kept, threads=1)
    before, done["again"] = len(fits), True
    got = M.cross_validate(df, "y", (), {"tree": fit}, kept=kept, threads=1).first()
    assert got.folds == 5 and before >= 3 and len(fits) == 5


def test_sparse_features_are_small_and_equal(spark):
    rng = random.Random(5)
    items = [f"s{i}" for i in range(50)]
    rows = [(i, rng.sample([*items, "other"], rng.randint(0, 5)), rng.randint(0, 3), rng.choice(["A", "B", "C", None])) for i in range(300)]
    df = spark.createDataFrame(rows, "vacancy_id int, skills array<string>, experience_level int, area string")
    got = M.sparse_features(df, items, "skills", "experience_level", "area", ["C", "B", "A"]).collect()
    for r, (_, own, level, area) in zip(sorted(got), rows, strict=True):
        want = [float(s in own) for s in items] + [float(level), float(area == "C"), float(area == "B")]
        assert r.features.toArray().tolist() == want
    stored = sum(len(r.features.values) * 12 if hasattr(r.features, "indices") else 53 * 8 for r in got)
    assert stored * 3 <= 53 * 8 * len(got)


def test_rules_grow_level_by_level(spark):
    rng = random.Random(6)
    baskets = [rng.sample("abcdefg", rng.randint(1, 6)) for _ in range(120)]
    support = {}
    for k in range(1, 7):
        for c in combinations("abcdefg", k):
            n = sum(set(c) <= set(b) for b in baskets)
            if n >= 4:
                support[c] = n / 120
    fi = spark.createDataFrame([(list(c), s) for c, s in support.items()], "items array<string>, support double")
    for least in (0.3, 0.6, 1.0):
        want = {(a, tuple(x for x in c if x not in a)) for c in support for k in range(1, len(c)) for a in combinations(c, k)
                if support[c] / support[a] >= least}
        got = [(tuple(r.antecedents), tuple(r.consequents)) for r in R.association_rules(fi, least).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_rules_of_a_long_itemset(spark):
    items = [f"i{k:02}" for k in range(31)]
    sets = [(items, 0.1)] + [([x], 0.2) for x in items] + [([x for x in items if x != y], 0.1 if y in items[:3] else 0.9) for y in items]
    got = R.association_rules(spark.createDataFrame(sets, "items array<string>, support double"), 0.8).collect()
    assert {tuple(r.consequents) for r in got if len(r.antecedents) == 30} == {(x,) for x in items[:3]}


def test_category_masks(spark):
    rng = random.Random(7)
    cats = [(f"c{i}", f"S {i}.{j % 4}", i) for i in range(130) for j in range(4)] + [("c0", "S 1.1", 0)]
    table = spark.createDataFrame(cats, "category string, skill string, ord int").withColumn(
        "slug", F.lower(F.replace(F.replace("skill", F.lit(" "), F.lit("_")), F.lit("."), F.lit(""))))
    slugs = {}
    for c, s, _ in cats:
        slugs.setdefault(c, set()).add(s.lower().replace(" ", "_").replace(".", ""))
    every = sorted(set().union(*slugs.values()) | {"x", "y"})
    rows = [(i, rng.sample(every, rng.randint(0, 9))) for i in range(500)]
    df = spark.createDataFrame(rows, "vacancy_id int, skill_slugs array<string>")
    got = {r.category: r.n for r in G.category_rows(table, df).collect()}
    assert got == {c: n for c, own in slugs.items() if (n := sum(bool(own & set(r[1])) for r in rows))}
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    plan = G.category_gap(table, df, n)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\([^)]*vacancy_id", plan) and "distinct" not in plan.lower()
    demand = {r.slug: r.market_pct for r in G.skill_demand(df, n, table).collect()}
    assert "x" not in demand and all(demand[s] == pytest.approx(sum(s in r[1] for r in rows) / 5) for s in demand)


def test_tagging_by_a_table(spark):
    rng = random.Random(8)
    marks = ["", "", "", " ", "+", "#", ".js", "-x", " y z", "/"]
    terms = sorted({rng.choice(["", ".", "@"]) * (rng.random() < 0.2) + "".join(rng.choices("abcdé1", k=rng.randint(1, 4))) + rng.choice(marks)
                    for _ in range(30_000)})
    terms = sorted({t for t in (x.strip() for x in terms) if t})[:20_000]
    texts = [None, "", "C++ c+ .net asp.net a.js", "é\n é"] + [
        "".join(rng.choice([*terms[:4000], "zz"]) + rng.choice([" ", " ", ",", "", "_", "\n"]) for _ in range(60)) for _ in range(40)]
    df = spark.createDataFrame([(i % 7, t) for i, t in enumerate(texts)], "doc_id int, text string")
    vocab = spark.createDataFrame([(t,) for t in [*terms, None, "", "C++", "asp.net", ".net"]], "term string")
    known = [*terms, "C++", "asp.net", ".net"]

    def want(text):
        low = (text or "").lower()
        runs = set(re.findall(r"[^\W]+", low))
        return sorted({t for t in known if (t.lower() in runs if re.fullmatch(r"\w+", t) else
                                            t.lower() in low and re.search(rf"(?<!\w){re.escape(t.lower())}(?!\w)", low))})
    for most in (100_000, 10):
        got = DI.tag_by_table(df, vocab, broadcast_rows=most).collect()
        assert sorted((r.text or "", r.skills_extracted) for r in got) == sorted((t or "", want(t)) for t in texts)
    few = [t for t in known if len(t) > 1][:100]
    both = DI.tag_by_table(df, spark.createDataFrame([(t,) for t in few], "term string")).select(
        "skills_extracted", F.sort_array(TX.tag_terms("text", few)).alias("w")).collect()
    assert [r.skills_extracted for r in both] == [r.w for r in both]


def test_thousands_of_paths(spark):
    rng = random.Random(9)
    skills = [f"s{i}" for i in range(400)]
    paths = [(f"p{i}", rng.sample(skills, rng.randint(1, 6))) for i in range(5000)] + [("base", ["none"])]
    users = [(i % 9, rng.sample(skills, rng.randint(0, 12))) for i in range(60)] + [(1, None), (2, ["unknown"])]
    prof = spark.createDataFrame(users, "user_id int, skills array<string>")
    got = AD.career_path(prof, AD.path_table(spark, paths), "base", broadcast_rows=10).collect()
    want = []
    for u, own in users:
        share = [(100.0 * len(set(ls) & set(own or [])) / len(ls), n) for n, ls in paths]
        best = max(share)[0]
        top = [n for s, n in share if s == best]
        want.append((u, top[0] if len(top) == 1 and best > 0 else "base"))
    assert sorted((r.user_id, r.path) for r in got) == sorted(want)


def test_density_from_cells(spark):
    rng = np.random.default_rng(10)
    rows = [("a", float(x)) for x in rng.normal(5e5, 2e5, 3000)] + [("b", float(x)) for x in rng.lognormal(3, 1, 500)] + [("c", 1.0), ("d", None)]
    df = spark.createDataFrame(rows, "k string, y double")
    exact = {(r.k, r[1]): r.density for r in V.density_curve(df, "k", "y", exact=True).select("k", "x", "density").collect()}
    got = {(r.k, r[1]): r.density for r in V.density_curve(df, "k", "y").select("k", "x", "density").collect()}
    assert exact.keys() == got.keys() and len(got) == 100
    for g in "ab":
        peak = max(v for k, v in exact.items() if k[0] == g)
        assert max(abs(got[k] - exact[k]) for k in got if k[0] == g) <= 1e-10 * peak


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.StringType()), T.StructField("v", T.StringType())])


def test_landing_reads_no_landed_row_again(spark, tmp_path):
    """Batches go on after what was landed is gone: keys are known from the
    state alone, so no batch reads what earlier ones wrote."""
    dirs = [str(tmp_path / x) for x in ("in", "out", "ck")]
    for k in range(3):
        rows = [(k * 100 + i, "2024-01-01T00:00:00", f"{k}") for i in range(100)] + [(i, "2025-01-01T00:00:00", "again") for i in range(k * 100)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(dirs[0])
        land_stream(spark, *dirs, SCHEMA, "id", "ts")
        got = read_landed(spark, dirs[1]).collect()
        assert len(got) == 100 and {r.v for r in got} == {f"{k}"}
        os.rename(dirs[1], f"{dirs[1]}-{k}")


def test_compaction_keeps_every_row(spark, tmp_path):
    dirs = [str(tmp_path / x) for x in ("in", "out", "ck")]
    for k in range(4):
        spark.createDataFrame([(i, "2024-01-01T00:00:00", f"{k}") for i in range(k * 5, k * 5 + 10)] + [(None, None, f"n{k}")], SCHEMA) \
            .write.mode("append").json(dirs[0])
        land_stream(spark, *dirs, SCHEMA, "id", "ts")
        if k == 2:
            before = sorted(map(repr, read_landed(spark, dirs[1]).collect()))
            compact_landed(spark, dirs[1], "id")
            assert sorted(map(repr, read_landed(spark, dirs[1]).collect())) == before
            assert len(_folders(spark, dirs[1])) == 1 and len([x for x in os.listdir(dirs[1]) if "=" in x]) == 1
    got = sorted((r.id if r.id is not None else -1, r.v) for r in read_landed(spark, dirs[1]).collect())
    assert got == sorted([(i, f"{max(0, (i - 5) // 5)}") for i in range(25)] + [(-1, f"n{k}") for k in range(4)])
    compact_landed(spark, dirs[1], "id")
    compact_landed(spark, dirs[1], "id")
    assert sorted((r.id if r.id is not None else -1, r.v) for r in read_landed(spark, dirs[1]).collect()) == got


def test_fits_in_threads_of_threads(spark):
    def inner(i):
        return spark.range(i).count()

    assert M.in_parallel(lambda k: M.in_parallel(inner, [k, k + 1]), [1, 2]) == [[1, 2], [2, 3]]


def test_files_of_repeated_texts_stay_small(spark, tmp_path):
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefghij \n\"") for _ in range(4000))
    df = spark.range(300).select("id", F.lit(text).alias("description")).coalesce(1)
    for write, read in ((FS.write_csv, lambda p: spark.read.csv(p, header=True, multiLine=True, escape='"')), (FS.write_json, spark.read.json)):
        path = str(tmp_path / write.__name__)
        write(df, path)
        assert sum(f.stat().st_size for f in (tmp_path / write.__name__).glob("part-*")) * 10 < 300 * len(text)
        back = read(path)
        assert back.count() == 300 and {r.description for r in back.select("description").distinct().collect()} == {text}


def test_forest_by_parts_is_the_forest(spark):
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.integers(0, 2, (600, 5)), rng.integers(0, 4, 600), rng.normal(size=600)]).astype(float)
    y = x @ np.array([5.0, 3.0, 0.0, 1.0, -2.0, 4.0, 2.0]) + 3 * x[:, 0] * x[:, 1]
    df = M.assemble(spark.createDataFrame([(i, list(map(float, a)), float(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))],
                                          "k int, a array<double>, y double"), ["a"]).cache()
    train = df.where("k % 4 > 0")
    whole, cut = (FO.fit(train, "y", df, trees=10, max_depth=30, seed=1, most=n) for n in (20_000, 40))
    a, b = ({r.k: r.prediction for r in f.transform(df).collect()} for f in (whole, cut))
    assert len(a) == 600 and all(a[k] == pytest.approx(b[k], rel=1e-9) for k in a)
    assert np.allclose(whole.importances, cut.importances) and whole.importances.sum() == pytest.approx(1.0)
    assert M.regression_metrics(cut.transform(df.where("k % 4 = 0")), "y").first()["r2"] > 0.85


def test_subtree_against_plain_recursion():
    rng = np.random.default_rng(12)
    code = rng.integers(0, 3, (60, 4)).astype(np.uint8)
    w, y = rng.poisson(1.0, 60).astype(float), rng.normal(size=60)

    def plain(rows, depth):
        tr = rows[w[rows] > 0]

        def sse(i):
            return (w[i] * (y[i] - np.average(y[i], weights=w[i])) ** 2).sum()

        best = max(((sse(tr) - sse(tr[lo]) - sse(tr[~lo]), f, c) for f in range(4) for c in range(2)
                    if (lo := code[tr, f] <= c).any() and not lo.all()), default=(0, 0, 0), key=lambda v: (v[0], -v[1], -v[2]))
        if depth == 3 or best[0] < 1e-9:
            return {int(r): np.average(y[tr], weights=w[tr]) for r in rows}
        left = code[rows, best[1]] <= best[2]
        return plain(rows[left], depth + 1) | plain(rows[~left], depth + 1)

    got, _ = FO.grow(FO.Bins([np.array([0.5, 1.5])] * 4), code, w, w * y, 0, 3)
    want = plain(np.arange(60), 0)
    assert np.allclose(got, [want[i] for i in range(60)])


def test_boosting_counts_a_vector_once(spark):
    from pyspark.ml.regression import GBTRegressor

    df = M.assemble(spark.createDataFrame([(i, [float(i % 2), float(i % 3)], float(i % 6 + i % 5)) for i in range(200)],
                                          "k int, a array<double>, y double"), ["a"])
    ours, rows = M.fit_gbt(df, "y", rounds=5), GBTRegressor(labelCol="y", maxIter=5, stepSize=0.1, maxDepth=3, seed=42).fit(df)
    a, b = ({r.k: r.prediction for r in m.transform(df).collect()} for m in (ours, rows))
    assert M.per_vector(df, "y").count() == 6 and all(a[k] == pytest.approx(b[k], rel=1e-9) for k in a)


def test_only_runs_that_begin_a_term_are_made(spark):
    texts = ["Use C++ or Power BI, not bi.", "node.js and Node", ".net, c#", "", "bi power"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    terms = spark.createDataFrame([(t,) for t in ("C++", "Power BI", "node.js", ".NET", "C#")], "term string")
    rows = docs.withColumn("_row", F.col("doc_id").cast("bigint"))
    firsts = ["c", "power", "node", "."]
    few, all_ = DI.text_grams(rows, "text", [1, 2, 3], firsts), DI.text_grams(rows, "text", [1, 2, 3])
    assert {r.gram for r in few.collect()} <= {r.gram for r in all_.collect()} and few.count() * 2 < all_.count()
    got = {r.doc_id: r.skills_extracted for r in DI.tag_by_table(docs, terms).collect()}
    assert got == {0: ["C++", "Power BI"], 1: ["node.js"], 2: [".NET", "C#"], 3: [], 4: []}


def test_a_filter_on_tags_holds_no_split_per_term(spark):
    from laborlens.plans import preprocess as PP

    texts = ["Python, C++ and vue.js", "c# go", "spring boot / Spring", "none here", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(2)
    tagged = PP.tag_texts(df, "text")
    found = tagged.select("doc_id", F.explode("skills_extracted").alias("item"))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("split(") <= 2      # one in the filter, one in the tags
    plain = {r.doc_id: r.t for r in df.select("doc_id", TX.tag_terms("text").alias("t")).collect()}
    assert {r.doc_id: r.skills_extracted for r in tagged.collect()} == plain
    assert sorted((r.doc_id, r["item"]) for r in found.collect()) == sorted((i, x) for i, xs in plain.items() for x in xs)


def test_set_union_makes_the_postings_once(spark):
    from laborlens.plans import registry

    df = registry.queries()["u04_set_union"](spark, "/root/testdata/sf0.001")
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [o_orderkey") == 1


def test_kmeans_counts_a_vector_once(spark):
    rng = np.random.default_rng(3)
    points = [[float(x), float(y)] for x, y in rng.integers(0, 4, (300, 2)).tolist()]
    df = M.assemble(spark.createDataFrame([(p,) for p in points], "p array<double>"), ["p"]).select("features")
    vectors, weight = M.kmeans_points(df)
    assert vectors.count() == len({tuple(p) for p in points}) and vectors.agg(F.sum(weight)).first()[0] == 300
    m = M.kmeans_fit(vectors, 3, n_init=2, weight=weight)
    near = [min(sum((a - b) ** 2 for a, b in zip(p, c)) for c in m.clusterCenters()) for p in points]
    assert m.summary.trainingCost == pytest.approx(sum(near)) and m.summary.predictions.count() == vectors.count()
    once = df.distinct()
    assert M.kmeans_points(once)[0] is once and M.kmeans_points(once)[1] is None      # nothing to gain


def test_summary_reads_written_profiles(spark):
    from laborlens.plans import registry

    df = registry.queries()["b13_summary_fixed_coefficients"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan and "element_at(" not in plan       # no branch parses or scores the profiles again
    assert plan.count("filter(_market") == 1                        # no second list for the explode's own filter


def test_linear_fit_deals_out_no_rows(spark, monkeypatch):
    from laborlens.plans import q_models as QM
    from laborlens.plans.build import building

    def sized(df, *_):
        raise AssertionError("rows are dealt out before a fit of one pass")
    monkeypatch.setattr(M, "sized", sized)
    monkeypatch.setattr(QM, "KEEP_TAG", "test-linear")
    with building():
        assert len(QM._model(spark, "/root/testdata/sf0.001", "ridge").coefficients) > 1


def test_few_points_grow_without_a_pass_per_level(spark, monkeypatch):
    made, crown = [], FO.crown
    monkeypatch.setattr(FO, "crown", lambda *a: made.append(crown(*a)) or made[-1])
    x = F.array((F.col("k") % 2).cast("double"), (F.col("k") / 7).cast("double"))
    df = M.assemble(spark.range(21_000).toDF("k").withColumn("a", x), ["a"]).withColumn("y", (F.col("k") % 5).cast("double"))
    forest = FO.fit(df, "y", trees=5, max_depth=4, seed=3)
    assert all(t["kind"].tolist() == [FO.LOCAL] for t in made[0][0])        # no top that is grown by jobs
    assert forest.scores.count() == 21_000 and forest.scores.where("prediction is null").count() == 0


def test_a_child_by_difference_is_its_sum():
    rng = np.random.default_rng(4)
    code = (rng.random((3000, 12)) < 0.1).astype(np.uint8)
    code[:, 0] = rng.integers(0, 4, 3000)
    w = rng.poisson(1.0, 3000).astype(float)
    s, bins = w * rng.normal(size=3000), FO.Bins([np.arange(3) + 0.5] + [np.array([0.5])] * 11)
    (a, b), (c, d) = (FO.grow(bins, code, w, s, 0, 30, direct=n) for n in (10**9, 50))
    assert np.allclose(a, c, rtol=1e-9) and np.allclose(b, d, rtol=1e-9)


def boosting_rows(spark, n=300):
    rng = np.random.default_rng(7)
    rows = [(i, [float(a), float(b), float(c)], float(2 * a + b + 3 * c * a + e))
            for i, (a, b, c, e) in enumerate(zip(*(rng.integers(0, k, n) for k in (2, 3, 2)), rng.normal(size=n), strict=True))]
    return M.assemble(spark.createDataFrame(rows, "k int, a array<double>, y double"), ["a"])


def test_boosting_is_one_task(spark, monkeypatch):
    from pyspark.ml.regression import GBTRegressor

    df = boosting_rows(spark)
    new = M.assemble(spark.createDataFrame([(-1, [5.0, 0.4, 1.0], None), (-2, [0.0, 9.0, 0.0], None)], "k int, a array<double>, y double"), ["a"])
    train, rows = df.where("k % 4 > 0"), df.union(new)
    own = GBTRegressor(labelCol="y", maxIter=20, stepSize=0.1, maxDepth=3, seed=42).fit(train)
    want = {r.k: r.prediction for r in own.transform(rows).collect()}

    def no_jobs(*_, **__):
        raise AssertionError("boosting by a job per level")
    monkeypatch.setattr("pyspark.ml.regression.GBTRegressor", no_jobs)
    got = {r.k: r.prediction for r in M.fit_gbt(train, "y", rounds=20, rows=rows).transform(rows).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-9) for k in want)


def test_boosting_by_mllib_where_a_task_does_not_do(spark, monkeypatch):
    df = boosting_rows(spark)
    vectors = M.per_vector(df, "y")
    assert FO.boost(vectors, "y", "_rows", most=5) is None and FO.boost(vectors, "y", "_rows", levels=2) is None
    one = {r.k: r.prediction for r in M.fit_gbt(df, "y", rounds=5).transform(df).collect()}
    monkeypatch.setattr(FO, "boost", lambda *a, **k: None)
    assert {r.k: r.prediction for r in M.fit_gbt(df, "y", rounds=5).transform(df).collect()} == pytest.approx(one, rel=1e-9)


def test_metrics_of_all_models_read_the_rows_once(spark):
    from laborlens.plans import q_models as QM
    from laborlens.plans.build import building

    d = "/root/testdata/sf0.001"
    with building():
        got = QM._metrics(spark, d, ["ridge", "lasso"])
        assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
        f, _ = QM.feature_frame(spark, d)
        pred = QM._model(spark, d, "lasso").transform(f.where(F.col(QM.Y).isNotNull()))
        test = M.regression_metrics(pred.where(~F.col("is_train")), QM.Y).first()
    row = [r for r in got.collect() if r.model == "lasso"][0]
    assert (row.test_rmse, row.test_mae, row.test_r2) == pytest.approx(tuple(test))


def test_folds_are_boosted_in_a_task_each(spark, monkeypatch):
    def no_jobs(*_, **__):
        raise AssertionError("boosting by a job per level")
    monkeypatch.setattr("pyspark.ml.regression.GBTRegressor", no_jobs)
    df = boosting_rows(spark)
    fits = {"forest": lambda t, y: M.fit_forest(t, y, trees=5, rows=df), "gbt": lambda t, y: M.fit_gbt(t, y, rounds=10, rows=df)}
    got = {r.model: r for r in M.cross_validate(df, "y", (), fits, key="k").collect()}
    assert got.keys() == {"forest", "gbt"} and all(r.folds == 5 and r.cv_mean > 0 for r in got.values())


def repeated_points(spark, copies=9):
    rng = np.random.default_rng(6)
    skills = [[f"s{j}" for j in np.flatnonzero(rng.random(8) < 0.3)] for _ in range(60)]
    rows = [(i * copies + c, float(i), s) for i, s in enumerate(skills) for c in range(copies)]
    df = spark.createDataFrame(rows, "vacancy_id int, y double, skill_slugs array<string>")
    return M.marks(df, [f"s{j}" for j in range(8)], "skill_slugs")


def test_all_starts_run_over_counted_points(spark, monkeypatch):
    from pyspark.ml.evaluation import ClusteringEvaluator

    from laborlens.operators import clusters as CL
    from laborlens.plans import q_models as QM

    df = repeated_points(spark).cache()
    assert {type(r.features).__name__ for r in df.select("features").collect()} == {"SparseVector"}
    points, weight = M.kmeans_points(df.select("features"))
    best = CL.best_starts(points, [2, 5], 4, 1)
    for k, (cost, silhouette, centres) in best.items():
        m = CL.model_of(spark, centres)
        near = [min(((r.features.toArray() - c) ** 2).sum() for c in centres) for r in df.collect()]
        assert len(m.clusterCenters()) == k and cost == pytest.approx(sum(near))
        assert silhouette == pytest.approx(ClusteringEvaluator().evaluate(m.transform(df)))
    again = CL.best_starts(points.repartition(5), [2, 5], 4, 1)
    assert all(again[k][:2] == pytest.approx(best[k][:2]) for k in best)    # whatever the layout

    def no_jobs(*_, **__):
        raise AssertionError("k-means by jobs")
    monkeypatch.setattr(M, "kmeans_fit", no_jobs)
    monkeypatch.setattr(QM, "_cluster_input", lambda *_: df)
    monkeypatch.setattr(QM, "FEW_ROWS", 0, raising=False)
    got = {r.k: r for r in QM.m13(spark, "none").collect()}
    assert sorted(got) == list(range(2, 11)) and got[2].inertia <= best[2][0] + 1e-9 and got[10].inertia < got[2].inertia


def test_points_with_few_values(spark):
    from laborlens.operators import clusters as CL

    x = np.array([[0.0, 0.0], [1.0, 0.0], [0.0, 2.5]])
    points = CL.Points(np.count_nonzero(x, axis=1), np.nonzero(x)[1], x[np.nonzero(x)], np.array([5.0, 1.0, 1.0]), 2)
    for k in (3, 6):                                    # no more centres than there are vectors
        cost, c = points.lloyd(points.start(k, np.random.default_rng(0)))
        assert cost == 0 and len(c) == 3
    assert points.silhouette(x[:1]) != points.silhouette(x[:1])             # one cluster: NaN
    assert points.silhouette(x) == pytest.approx(5 / 7)                     # a row alone has 0


def test_clusters_keep_no_rows_in_memory(spark, monkeypatch):
    from laborlens.plans import q_models as QM

    df = repeated_points(spark)
    kept = []
    frame = type(df)
    for name in ("persist", "cache"):
        monkeypatch.setattr(frame, name, lambda self, *a, f=getattr(frame, name): kept.append(self.columns) or f(self, *a))
    monkeypatch.setattr(QM, "_cluster_input", lambda *_: df)
    monkeypatch.setattr(QM, "FEW_ROWS", 0, raising=False)
    monkeypatch.setattr(QM, "KEEP_TAG", "test-clusters")
    got = {r.vacancy_id: r.cluster for r in QM._clusters(spark, "none").collect()}
    assert not kept and len(got) == 540 and set(got.values()) == {0, 1}
    assert all(len({got[i * 9 + c] for c in range(9)}) == 1 for i in range(60))
