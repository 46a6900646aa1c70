"""Queries: windows/top-k, set operations, joins, category gap and
association rules (W-, U-, J-, A15/A16, M16-M18 series)."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions import scalar as S
from ..functions import text as T
from ..operators import gap as G
from ..operators import rules as R
from ..operators import skills as SK
from ..operators.quantiles import ecdf, running_sum
from ..sources.tables import read_table
from . import preprocess as PP
from .catalog import register, rnd, with_ctes
from .q_stats import MAJOR_SQL, Y, n_rows, proc, skill_rows, skill_sums
from .q_tests import _PAIR_P_SQL

_FREQ_SQL = "(SELECT skill, count(*) AS frequency FROM posting_skill GROUP BY skill)"


# ------------------------------------------------------------------ W-series

@register("w01_with_rank", with_ctes(
    f"SELECT skill, frequency, row_number() OVER (ORDER BY frequency DESC, skill) AS rank FROM {_FREQ_SQL}"))
def w01(spark, d):
    long = PP.skill_long(skill_rows(spark, d, salary=False))
    f = long.groupBy("skill").agg(F.count(F.lit(1)).alias("frequency"))
    # skills are free text, so even their summary is ranked over range partitions
    f = f.withColumn("_nf", -F.col("frequency")).withColumn("_one", F.lit(1).cast("bigint"))
    return running_sum(f, [], ["_nf", "skill"], "_one").select("skill", "frequency", F.col("_cum").alias("rank"))


@register("w02_top_k_per_group", with_ctes(
    "SELECT area_normalized, skill, n, rank FROM (SELECT area_normalized, skill, n, row_number() OVER "
    "(PARTITION BY area_normalized ORDER BY n DESC, skill) AS rank FROM (SELECT p.area_normalized, ps.skill, count(*) AS n "
    "FROM posting_skill ps JOIN processed p USING (vacancy_id) GROUP BY 1, 2) WHERE n > 0) WHERE rank <= 5"))
def w02(spark, d):
    p = skill_rows(spark, d, salary=False)
    c = SK.explode_items(p, "area_normalized").groupBy("area_normalized", "skill").agg(F.count(F.lit(1)).alias("n"))
    return SK.top_k_per_group(c, ["area_normalized"], "n", 5, "skill").select("area_normalized", "skill", "n", "rank")


@register("w03_ecdf", "SELECT value, round(row_number() OVER (ORDER BY value) / count(*) OVER (), 8) AS ecdf FROM events "
          "WHERE value IS NOT NULL")
def w03(spark, d):
    e = ecdf(read_table(spark, d, "events"), "value")
    return e.select("value", rnd("ecdf", 8).alias("ecdf"))


@register("w04_global_sort", with_ctes(
    "SELECT vacancy_id, salary_monthly_kzt AS salary FROM processed WHERE salary_monthly_kzt IS NOT NULL "
    "ORDER BY salary DESC, vacancy_id"))
def w04(spark, d):
    p = proc(spark, d).where(F.col(Y).isNotNull())
    return p.select("vacancy_id", F.col(Y).alias("salary")).orderBy(F.desc("salary"), "vacancy_id")


@register("w05_top_bottom_n", with_ctes(
    "(SELECT 'top' AS side, vacancy_id, salary_monthly_kzt AS salary FROM processed WHERE salary_monthly_kzt IS NOT NULL "
    "ORDER BY salary_monthly_kzt DESC, vacancy_id LIMIT 10) UNION ALL (SELECT 'bottom', vacancy_id, salary_monthly_kzt "
    "FROM processed WHERE salary_monthly_kzt IS NOT NULL ORDER BY salary_monthly_kzt ASC, vacancy_id LIMIT 10)"))
def w05(spark, d):
    p = proc(spark, d).where(F.col(Y).isNotNull()).select("vacancy_id", F.col(Y).alias("salary"))
    top = p.orderBy(F.desc("salary"), "vacancy_id").limit(10).select(F.lit("top").alias("side"), "*")
    bottom = p.orderBy(F.asc("salary"), "vacancy_id").limit(10).select(F.lit("bottom").alias("side"), "*")
    return top.unionByName(bottom)


@register("w06_n_largest", "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 10")
def w06(spark, d):
    return read_table(spark, d, "events").select("event_id", "value").orderBy(F.desc("value"), "event_id").limit(10)


@register("w07_sample_n", f"SELECT event_id, value FROM events ORDER BY md5(event_id || ':{K.SPLIT_SEED}'), event_id LIMIT {K.SAMPLE_ROWS}")
def w07(spark, d, n: int = K.SAMPLE_ROWS, seed: int = K.SPLIT_SEED):
    """At most n rows, chosen by a seeded hash of the key: the same rows on
    every run and under any partitioning (distributed top-k on the hash)."""
    ev = read_table(spark, d, "events").select("event_id", "value")
    return ev.orderBy(F.md5(F.concat(F.col("event_id").cast("string"), F.lit(f":{seed}"))), "event_id").limit(n)


# ------------------------------------------------------------------ U-series

def _path_arr(i):
    return T.str_array(K.CAREER_PATHS[i][1])


def _path_sql(i):
    return "[" + ", ".join(f"'{s}'" for s in K.CAREER_PATHS[i][1]) + "]"


@register("u01_set_difference", with_ctes(
    "SELECT vacancy_id, array_to_string(list_sort(list_distinct(list_filter(skills_key_parsed, "
    "lambda x: NOT list_contains(skills_extracted, x)))), '|') AS key_only FROM processed"))
def u01(spark, d):
    p = PP.processed_postings(spark, d, winsorise=False)
    return p.select("vacancy_id", F.array_join(F.array_sort(F.array_except("skills_key_parsed", "skills_extracted")), "|")
                    .alias("key_only"))


@register("u02_items_missing", with_ctes(
    f"SELECT vacancy_id, array_to_string(list_sort(list_distinct(list_filter({_path_sql(0)}, "
    "lambda x: NOT list_contains(skill_slugs, x)))), '|') AS to_master FROM processed"))
def u02(spark, d):
    p = PP.processed_postings(spark, d, winsorise=False)
    return p.select("vacancy_id", F.array_join(F.array_sort(F.array_except(_path_arr(0), "skill_slugs")), "|").alias("to_master"))


@register("u03_items_held", with_ctes(
    f"SELECT vacancy_id, array_to_string(list_sort(list_distinct(list_filter({_path_sql(1)}, "
    "lambda x: list_contains(skill_slugs, x)))), '|') AS held FROM processed"))
def u03(spark, d):
    p = PP.processed_postings(spark, d, winsorise=False)
    return p.select("vacancy_id", F.array_join(F.array_sort(F.array_intersect(_path_arr(1), "skill_slugs")), "|").alias("held"))


@register("u04_set_union", with_ctes(
    "SELECT DISTINCT x AS item FROM (SELECT unnest(skills_key_parsed) AS x FROM processed UNION ALL "
    "SELECT unnest(skills_extracted) FROM processed)"))
def u04(spark, d):
    p = PP.processed_postings(spark, d, winsorise=False)
    # both lists of a posting in its own row: the postings are made once
    return p.select(F.explode(F.array_union("skills_key_parsed", "skills_extracted")).alias("item")).distinct()


# ------------------------------------------------------------------ J-series
# Premiums for the join operators: the raw per-skill premium of A9 (mean
# with minus mean without), so both engines compute the same table.

# Only skills that are model features (the top list) have one, as in the study.

_TOP50_CTE = """
top50 AS (SELECT skill FROM posting_skill GROUP BY skill ORDER BY count(*) DESC, skill LIMIT 50)"""
_PREM_ALL_SQL = _TOP50_CTE + """,
prem AS (
  SELECT skill, (s_with / n_with) - (s_all - s_with) / (n_all - n_with) AS premium FROM (
    SELECT skill, count(*) AS n_with, sum(y) AS s_with FROM posting_skill
    JOIN (SELECT vacancy_id, salary_monthly_kzt AS y FROM processed WHERE salary_monthly_kzt IS NOT NULL) r USING (vacancy_id)
    WHERE skill IN (SELECT skill FROM top50)
    GROUP BY skill) CROSS JOIN (SELECT count(*) AS n_all, sum(salary_monthly_kzt) AS s_all FROM processed
    WHERE salary_monthly_kzt IS NOT NULL) WHERE n_with > 10 AND n_all - n_with > 10)"""


def feature_skills(spark, d):
    """The top list that is the models' feature list: at most 50 skills."""
    return SK.top_of(skill_sums(spark, d), K.TOP_N_SKILLS).select("skill")


def premiums_raw(spark, d):
    """Premium per feature skill: at most as many rows as the top list has."""
    prem = SK.item_premium(skill_sums(spark, d), top=None).select("skill", "premium")
    return prem.join(F.broadcast(feature_skills(spark, d)), "skill")


@register("j01_premiums_for", with_ctes(
    "WITH " + _PREM_ALL_SQL + " SELECT vacancy_id AS user_id, skill, round(premium, 2) AS premium "
    "FROM posting_skill JOIN prem USING (skill)"))
def j01(spark, d):
    long = PP.skill_long(skill_rows(spark, d))
    return long.join(F.broadcast(premiums_raw(spark, d)), "skill").select(
        F.col("vacancy_id").alias("user_id"), "skill", rnd("premium").alias("premium"))


@register("j02_premiums_missing", with_ctes(
    "WITH " + _PREM_ALL_SQL + ", lst AS (SELECT list(skill ORDER BY premium DESC, skill) AS skills FROM prem) "
    "SELECT vacancy_id AS user_id, CAST(len(list_filter(lst.skills, lambda x: NOT list_contains(p.skill_slugs, x))) AS BIGINT) "
    "AS n_missing, array_to_string(list_filter(lst.skills, lambda x: NOT list_contains(p.skill_slugs, x))[1:3], '|') AS top3 "
    "FROM processed p CROSS JOIN lst"))
def j02(spark, d):
    p = skill_rows(spark, d)
    ranked = premiums_raw(spark, d).agg(F.sort_array(F.collect_list(F.struct(-F.col("premium"), F.col("skill")))).alias("_s")) \
        .select(F.transform("_s", lambda x: x["skill"]).alias("_skills"))
    # one row with the premium list (at most 50 skills), compared per row: no pairs
    missing = F.filter("_skills", lambda x: ~F.array_contains("skill_slugs", x))
    return p.crossJoin(F.broadcast(ranked)).select(
        F.col("vacancy_id").alias("user_id"), F.size(missing).cast("bigint").alias("n_missing"),
        F.array_join(F.slice(missing, 1, 3), "|").alias("top3"))


@register("j03_lookup_frequency", with_ctes(
    "SELECT t.term, round(coalesce(f.pct, 0), 6) AS pct FROM (SELECT DISTINCT lower(replace(replace(x, ' ', '_'), '.', '')) AS term "
    "FROM (SELECT unnest(" + "[" + ", ".join("'" + s + "'" for s in K.TECH_TERMS) + "]) AS x)) t LEFT JOIN ("
    "SELECT skill, 100.0 * count(DISTINCT vacancy_id) / (SELECT count(*) FROM processed) AS pct FROM posting_skill GROUP BY skill) f "
    "ON f.skill = t.term"))
def j03(spark, d):
    p = skill_rows(spark, d, salary=False)
    terms = spark.createDataFrame([(t,) for t in K.TECH_TERMS], "t string").select(S.slug("t").alias("term")).distinct()
    demand = G.skill_demand(p, n_rows(p), terms.select(F.col("term").alias("slug")))
    j = terms.join(demand.withColumnRenamed("slug", "term"), "term", "left")
    return j.select("term", rnd(F.coalesce("market_pct", F.lit(0.0)), 6).alias("pct"))


@register("j04_group_pairs", with_ctes(
    "WITH m AS (SELECT area_normalized AS g, count(*) AS n FROM processed GROUP BY 1) "
    "SELECT a.g AS group_1, b.g AS group_2, a.n AS n_1, b.n AS n_2 FROM m a JOIN m b ON a.g < b.g"))
def j04(spark, d):
    m = proc(spark, d).groupBy("area_normalized").agg(F.count(F.lit(1)).alias("n"))
    a = m.select(F.col("area_normalized").alias("group_1"), F.col("n").alias("n_1"))
    b = m.select(F.col("area_normalized").alias("group_2"), F.col("n").alias("n_2"))
    # theta join on the group summary (one row per group)
    return a.join(b, F.col("group_1") < F.col("group_2")).select("group_1", "group_2", "n_1", "n_2")


@register("j06_vs_global", with_ctes(
    "SELECT vacancy_id, round(salary_monthly_kzt - avg(salary_monthly_kzt) OVER (), 2) AS diff_from_mean FROM processed "
    "WHERE salary_monthly_kzt IS NOT NULL"))
def j06(spark, d):
    p = proc(spark, d).where(F.col(Y).isNotNull())
    g = p.agg(F.avg(Y).alias("_mean"))
    return p.crossJoin(F.broadcast(g)).select("vacancy_id", rnd(F.col(Y) - F.col("_mean")).alias("diff_from_mean"))


_TAUGHT_LOW_SQL = "[" + ", ".join("'" + s.lower() + "'" for s in K.TAUGHT_SKILLS) + "]"


@register("j08_flag_taught", with_ctes(
    f"SELECT DISTINCT skill, list_contains({_TAUGHT_LOW_SQL}, lower(skill)) AS taught FROM posting_skill"))
def j08(spark, d):
    s = PP.posting_skills(spark, d).select("skill").distinct()
    return G.flag_taught(s, "skill", K.TAUGHT_SKILLS)


# ------------------------------------------------------- A15 / A16 / J5 gap

def _cats_sql():
    rows = ", ".join(f"('{c}', '{s}', {i})" for i, (c, skills) in enumerate(K.SKILL_CATEGORIES) for s in skills)
    return f"cats AS (SELECT c AS category, s AS skill, o AS ord, lower(replace(replace(s, ' ', '_'), '.', '')) AS slug FROM (VALUES {rows}) v(c, s, o))"


_GAP_SQL = (
    "WITH " + _cats_sql() + ", "
    "n AS (SELECT count(*) AS n FROM processed), "
    "dem AS (SELECT skill AS slug, 100.0 * count(DISTINCT vacancy_id) / (SELECT n FROM n) AS market_pct FROM posting_skill GROUP BY skill), "
    f"agg AS (SELECT category, count(*) AS total, count_if(list_contains({_TAUGHT_LOW_SQL}, lower(skill))) AS taught, "
    "sum(coalesce(market_pct, 0)) AS market FROM cats LEFT JOIN dem USING (slug) GROUP BY category), "
    "anyp AS (SELECT category, 100.0 * count(DISTINCT vacancy_id) / (SELECT n FROM n) AS market_pct_any FROM posting_skill ps "
    "JOIN cats c ON c.slug = ps.skill GROUP BY category), "
    "g AS (SELECT category, market - 100.0 * taught / total AS gap, 100.0 * taught / total AS coverage, market, "
    "coalesce(market_pct_any, 0) AS market_pct_any, CAST(taught AS BIGINT) AS taught, CAST(total AS BIGINT) AS total "
    "FROM agg LEFT JOIN anyp USING (category)) ")


@register("a15_category_gap", with_ctes(
    _GAP_SQL + "SELECT category, round(gap, 6) AS gap, round(coverage, 6) AS coverage, round(market, 6) AS market, "
    "round(market_pct_any, 6) AS market_pct_any, taught, total, CASE WHEN gap < 0 THEN 'EXCELLENT' WHEN gap < 10 THEN 'GOOD' "
    "WHEN gap < 20 THEN 'MEDIUM' ELSE 'HIGH' END AS status FROM g ORDER BY gap"))
def a15(spark, d):
    p = skill_rows(spark, d, salary=False)
    g = G.category_gap(G.category_table(spark), p, n_rows(p))
    return g.select("category", *[rnd(c, 6).alias(c) for c in ["gap", "coverage", "market", "market_pct_any"]],
                    "taught", "total", "status")


@register("a16_gap_summary", with_ctes(
    _GAP_SQL + "SELECT count(*) AS n_categories, count_if(gap < 0) AS n_excellent, count_if(gap >= 0 AND gap < 10) AS n_good, "
    "arg_min(category, (gap, category)) AS top_strength, round(min(gap), 6) AS top_gap FROM g"))
def a16(spark, d):
    p = skill_rows(spark, d, salary=False)
    g = G.category_gap(G.category_table(spark), p, n_rows(p))
    s = G.gap_summary(g)
    return s.select("n_categories", "n_excellent", "n_good", "top_strength", rnd("top_gap", 6).alias("top_gap"))


@register("j05_category_demand", with_ctes(
    "WITH " + _cats_sql() + ", dem AS (SELECT skill AS slug, 100.0 * count(DISTINCT vacancy_id) / (SELECT count(*) FROM processed) "
    "AS market_pct FROM posting_skill GROUP BY skill) SELECT category, skill, round(coalesce(market_pct, 0), 6) AS market_pct "
    "FROM cats LEFT JOIN dem USING (slug)"))
def j05(spark, d):
    p = skill_rows(spark, d, salary=False)
    cats = G.category_table(spark)
    j = G.category_demand(cats, G.skill_demand(p, n_rows(p), cats))
    return j.select("category", "skill", rnd("market_pct", 6).alias("market_pct"))


# ------------------------------------------------------------ M16 - M18

def type_baskets(spark, d):
    """Basket per order: its distinct part types (empty when no lines)."""
    o = read_table(spark, d, "orders").select("o_orderkey")
    lp = read_table(spark, d, "lineitem").select("l_orderkey", "l_partkey").join(
        read_table(spark, d, "part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    t = lp.groupBy("l_orderkey").agg(F.collect_set("p_type").alias("items"))
    return o.join(t, o.o_orderkey == t.l_orderkey, "left").select(
        "o_orderkey", F.coalesce("items", F.array().cast("array<string>")).alias("items"))


_SETS_SQL = """
types AS (SELECT p_type, CAST(row_number() OVER (ORDER BY p_type) - 1 AS BIGINT) AS bit FROM (SELECT DISTINCT p_type FROM part)),
b AS (SELECT o.o_orderkey, coalesce(bit_or(CAST(1 AS BIGINT) << t.bit), 0) AS m FROM orders o
  LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey LEFT JOIN part p ON p.p_partkey = l.l_partkey
  LEFT JOIN types t ON t.p_type = p.p_type GROUP BY o.o_orderkey),
nb AS (SELECT count(*) AS n FROM b),
masks AS (SELECT range AS x FROM range(1, (SELECT CAST(1 AS BIGINT) << count(*) FROM types))),
sets AS (SELECT x, count(*) FILTER (WHERE (b.m & x) = x) AS freq FROM masks CROSS JOIN b GROUP BY x),
fsets AS (SELECT x, freq, freq / (SELECT n FROM nb) AS support FROM sets WHERE freq >= 0.05 * (SELECT n FROM nb)),
names AS (SELECT x, string_agg(p_type, ', ' ORDER BY p_type) AS items, count(*) AS k FROM masks JOIN types ON (x >> bit) & 1 = 1 GROUP BY x)"""


@register("m16_frequent_itemsets", with_ctes(
    "WITH " + _SETS_SQL + " SELECT items, CAST(k AS BIGINT) AS n_items, freq, round(support, 6) AS support FROM fsets JOIN names USING (x)",
    processed=False))
def m16(spark, d):
    fi = R.frequent_itemsets(type_baskets(spark, d), "items", K.MIN_SUPPORT)
    return fi.select(F.array_join("items", ", ").alias("items"), F.size("items").cast("bigint").alias("n_items"),
                     "freq", rnd("support", 6).alias("support"))


_RULES_SQL = _SETS_SQL + """,
rules AS (SELECT xs.x, a.x AS ax, xs.support, xs.support / a.support AS confidence,
    xs.support / a.support / c.support AS lift
  FROM fsets xs JOIN fsets a ON (a.x & xs.x) = a.x AND a.x <> xs.x
  JOIN fsets c ON c.x = xs.x - a.x)"""


@register("m17_association_rules", with_ctes(
    "WITH " + _RULES_SQL + " SELECT na.items AS antecedents, nc.items AS consequents, round(support, 6) AS support, "
    "round(confidence, 6) AS confidence, round(lift, 6) AS lift FROM rules JOIN names na ON na.x = rules.ax "
    "JOIN names nc ON nc.x = rules.x - rules.ax WHERE confidence >= 0.5", processed=False))
def m17(spark, d):
    fi = R.frequent_itemsets(type_baskets(spark, d), "items", K.MIN_SUPPORT)
    r = R.association_rules(fi, K.MIN_CONFIDENCE)
    return r.select(F.array_join("antecedents", ", ").alias("antecedents"), F.array_join("consequents", ", ").alias("consequents"),
                    *[rnd(c, 6).alias(c) for c in ["support", "confidence", "lift"]])


@register("m18_rules_summary", with_ctes(
    "WITH " + _RULES_SQL + " SELECT count(*) AS n_rules, round(max(lift), 6) AS max_lift FROM rules WHERE confidence >= 0.5",
    processed=False))
def m18(spark, d):
    fi = R.frequent_itemsets(type_baskets(spark, d), "items", K.MIN_SUPPORT)
    s = R.rules_summary(R.association_rules(fi, K.MIN_CONFIDENCE))
    return s.select("n_rules", rnd("max_lift", 6).alias("max_lift"))


# ------------------------------------------------ C11 / C22 / C27 / A20

_TOP50_LIST_SQL = ("(SELECT list(skill ORDER BY n DESC, skill) AS t50 FROM (SELECT skill, count(DISTINCT vacancy_id) AS n "
                   "FROM posting_skill GROUP BY skill ORDER BY n DESC, skill LIMIT 50))")


@register("c11_multi_hot_top_n", with_ctes(
    "SELECT vacancy_id, array_to_string(list_transform(t50, lambda x: CASE WHEN list_contains(skill_slugs, x) THEN '1' ELSE '0' END), '') "
    f"AS hot FROM processed CROSS JOIN {_TOP50_LIST_SQL}"))
def c11(spark, d):
    """0/1 string over the top-50 skills in rank order, per posting."""
    p = skill_rows(spark, d, salary=False)
    return SK.multi_hot(p, SK.top_items(PP.skill_long(p), K.TOP_N_SKILLS))


@register("c22_fill_indicators", with_ctes(
    "SELECT vacancy_id, CAST(coalesce(k, 0) AS BIGINT) AS n_top_skills, coalesce(k, 0) > 0 AS has_top_skill FROM processed "
    "LEFT JOIN (SELECT vacancy_id, count(*) AS k FROM posting_skill WHERE skill IN (SELECT unnest(t50) FROM "
    f"{_TOP50_LIST_SQL}) GROUP BY vacancy_id) USING (vacancy_id)"))
def c22(spark, d):
    """Indicator counts of the top list per posting; missing -> 0, then the
    0/1 flag cast to boolean."""
    p = skill_rows(spark, d, salary=False)
    hot = SK.hot_array(p, SK.top_items(PP.skill_long(p), K.TOP_N_SKILLS), "_hot")
    k = F.aggregate("_hot", F.lit(0.0), lambda a, b: a + b)
    filled = S.fill_indicator(F.when(k > 0, k.cast("int")))
    return hot.select("vacancy_id", filled.cast("bigint").alias("n_top_skills"),
                      F.least(filled, F.lit(1)).cast("boolean").alias("has_top_skill"))


_SALARY_COLS = ["salary_from", "salary_to", "salary_currency", "salary_raw_kzt", "salary_monthly_kzt"]


@register("c27_columns_with_prefix", with_ctes("SELECT vacancy_id, " + ", ".join(_SALARY_COLS) + " FROM processed"))
def c27(spark, d):
    """Columns chosen by name prefix at plan time (here ``salary_``)."""
    p = PP.processed_postings(spark, d, skills=False)
    return p.select("vacancy_id", *[c for c in p.columns if c.startswith("salary_")])


@register("a20_regional_summary", with_ctes(
    "WITH pr AS (" + _PAIR_P_SQL + "), st AS (SELECT round_even(avg(salary_monthly_kzt), 0) AS mean FROM processed "
    f"WHERE salary_monthly_kzt IS NOT NULL AND area_normalized IN {MAJOR_SQL} GROUP BY area_normalized) "
    "SELECT (SELECT max(mean) - min(mean) FROM st) AS largest_gap, (SELECT count(*) FROM st) AS n_groups, "
    "count_if(significant) AS n_significant, count(*) AS n_pairs FROM pr"))
def a20(spark, d):
    """Largest gap between city means; number of significant pairs
    (Bonferroni, JVM t tails)."""
    from ..operators import aggregates as A
    from ..operators import inference as I

    p = proc(spark, d).where(F.col("area_normalized").isin(K.MAJOR_CITIES))
    stats = A.group_stats(p, "area_normalized", Y, ("count", "mean"), sort=False)
    pairs = I.pairwise_ttests(p, "area_normalized", Y, K.MAJOR_CITIES)
    return A.regional_summary(stats, pairs)
