"""Queries: cleaning, profiling and scalar functions (C-, P- series)."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions import scalar as S
from ..functions import text as T
from ..operators import dictionary as DI
from ..operators import profile as P
from ..sources.adapter import postings
from ..sources.tables import read_table
from . import preprocess as PP
from .catalog import big, register, rnd, with_ctes


def _proc(spark, d):
    return PP.processed_postings(spark, d, skills=False)


# ------------------------------------------------------------------ C-series

@register("c01_range_midpoint", with_ctes(
    "SELECT vacancy_id, CASE WHEN salary_from IS NOT NULL AND salary_to IS NOT NULL "
    "THEN (salary_from + salary_to) / 2 ELSE coalesce(salary_from, salary_to) END AS salary_mid FROM postings",
    processed=False))
def c01(spark, d):
    p = postings(spark, d, with_description=False)
    return p.select("vacancy_id", S.range_midpoint("salary_from", "salary_to").alias("salary_mid"))


@register("c02_to_base_currency", with_ctes(
    "SELECT vacancy_id, salary_currency, salary_raw_kzt AS salary_kzt FROM processed0"))
def c02(spark, d):
    p = PP.clean_salaries(postings(spark, d, with_description=False), out="salary_kzt")
    return p.select("vacancy_id", "salary_currency", "salary_kzt")


@register("c03_normalize_category", with_ctes(
    "SELECT area_normalized, count(*) AS n FROM processed0 GROUP BY 1"))
def c03(spark, d):
    p = PP.normalize_locations(postings(spark, d, with_description=False))
    return p.groupBy("area_normalized").agg(F.count(F.lit(1)).alias("n"))


@register("c04_encode_ordinal", with_ctes(
    "SELECT vacancy_id, experience, CAST(experience_level AS BIGINT) AS experience_level FROM processed0"))
def c04(spark, d):
    p = PP.encode_experience(postings(spark, d, with_description=False))
    return p.select("vacancy_id", "experience", big("experience_level").alias("experience_level"))


@register("c05_decode_ordinal", with_ctes(
    "SELECT vacancy_id, CASE experience_level WHEN 0 THEN 'No Experience' WHEN 1 THEN '1-3 years' "
    "WHEN 2 THEN '3-6 years' WHEN 3 THEN '6+ years' END AS experience_label FROM processed0"))
def c05(spark, d):
    p = PP.encode_experience(postings(spark, d, with_description=False))
    return p.select("vacancy_id", S.decode_ordinal("experience_level").alias("experience_label"))


@register("c06_tag_terms", with_ctes(
    "SELECT doc_id, array_to_string(skills_extracted, '|') AS terms, CAST(len(skills_extracted) AS BIGINT) AS n_terms "
    "FROM doc_tags"))
def c06(spark, d):
    t = PP.document_tags(spark, d)
    return t.select("doc_id", F.array_join("skills_extracted", "|").alias("terms"),
                    big(F.size("skills_extracted")).alias("n_terms"))


@register("c06_tag_by_table", with_ctes(
    "SELECT doc_id, array_to_string(list_sort(skills_extracted), '|') AS terms, CAST(len(skills_extracted) AS BIGINT) AS n_terms "
    "FROM doc_tags"))
def c06t(spark, d):
    """The same terms from a table: one hash join instead of an expression
    per term."""
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    terms = spark.createDataFrame([(t,) for t in K.TECH_TERMS], "term string")
    t = DI.tag_by_table(docs, terms)
    return t.select("doc_id", F.array_join("skills_extracted", "|").alias("terms"), big(F.size("skills_extracted")).alias("n_terms"))


@register("c07_parse_list_text", with_ctes(
    "SELECT vacancy_id, array_to_string(skills_key_parsed, '|') AS parsed, CAST(len(skills_key_parsed) AS BIGINT) AS n_parsed "
    "FROM processed0"))
def c07(spark, d):
    p = postings(spark, d, with_description=False).withColumn("parsed", T.parse_list_text("key_skills"))
    return p.select("vacancy_id", F.array_join("parsed", "|").alias("parsed"), big(F.size("parsed")).alias("n_parsed"))


@register("c08_merge_arrays", with_ctes(
    "SELECT vacancy_id, array_to_string(skills_all, '|') AS skills_all FROM processed"))
def c08(spark, d):
    p = PP.processed_postings(spark, d, winsorise=False)
    return p.select("vacancy_id", F.array_join("skills_all", "|").alias("skills_all"))


@register("c09_slug", with_ctes(
    "SELECT skill, count(*) AS n_postings FROM posting_skill GROUP BY skill"))
def c09(spark, d):
    return PP.posting_skills(spark, d).groupBy("skill").agg(F.count(F.lit(1)).alias("n_postings"))


_TITLE_SQL = ("list_reduce(list_transform(regexp_extract_all(lower({x}), '(\\p{{L}}+|\\P{{L}}+)', 1), "
              "lambda w: upper(w[1]) || w[2:]), lambda a, b: a || b)")


@register("c10_title_label", with_ctes(
    "SELECT DISTINCT skill, " + _TITLE_SQL.format(x="replace(replace(skill, 'skill_', ''), '_', ' ')") +
    " AS label FROM posting_skill"))
def c10(spark, d):
    return PP.posting_skills(spark, d).select("skill", S.title_label("skill").alias("label")).distinct()


@register("c12_iqr_outliers", "SELECT round(q1, 4) AS q1, round(q3, 4) AS q3, round(lo, 4) AS lower_bound, "
          "round(hi, 4) AS upper_bound, n_outliers, round(100.0 * n_outliers / n, 4) AS outlier_pct FROM ("
          "SELECT q1, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi, "
          "(SELECT count(*) FROM events WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS n_outliers, "
          "(SELECT count(value) FROM events) AS n FROM (SELECT quantile_cont(value, 0.25) AS q1, "
          "quantile_cont(value, 0.75) AS q3 FROM events))")
def c12(spark, d):
    ev = read_table(spark, d, "events").select("value")
    b = PP.iqr_bounds(ev, "value")
    cnt = ev.crossJoin(F.broadcast(b)).agg(
        F.count_if((F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound"))).alias("n_outliers"),
        F.count("value").alias("n"))
    return b.crossJoin(cnt).select(rnd("q1", 4).alias("q1"), rnd("q3", 4).alias("q3"),
                                   rnd("lower_bound", 4).alias("lower_bound"), rnd("upper_bound", 4).alias("upper_bound"),
                                   "n_outliers", rnd(S.pct("n_outliers", "n"), 4).alias("outlier_pct"))


@register("c13_winsorize_iqr", "WITH b AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM "
          "(SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)) "
          "SELECT event_id, CASE WHEN value IS NULL THEN NULL ELSE least(greatest(value, lo), hi) END AS value_capped "
          "FROM events CROSS JOIN b")
def c13(spark, d):
    ev = read_table(spark, d, "events").select("event_id", "value")
    w = PP.winsorize(ev, "value", out="value_capped")
    return w.select("event_id", "value_capped")


@register("c14_null_filter", with_ctes(
    "SELECT vacancy_id, salary_monthly_kzt AS salary FROM processed WHERE salary_monthly_kzt IS NOT NULL"))
def c14(spark, d):
    p = _proc(spark, d)
    return p.where(F.col("salary_monthly_kzt").isNotNull()).select("vacancy_id", F.col("salary_monthly_kzt").alias("salary"))


@register("c15_keep_values", with_ctes(
    "SELECT vacancy_id, area_normalized FROM processed0 WHERE area_normalized IN ('Almaty', 'Astana', 'Shymkent', 'Other')"))
def c15(spark, d):
    p = PP.normalize_locations(postings(spark, d, with_description=False))
    return p.where(F.col("area_normalized").isin(K.MAJOR_CITIES)).select("vacancy_id", "area_normalized")


@register("c16_flag_regex", with_ctes(
    "SELECT vacancy_id, regexp_matches(coalesce(schedule, ''), '(?i)" + K.REMOTE_PATTERN + "') AS is_remote FROM postings",
    processed=False))
def c16(spark, d):
    p = postings(spark, d, with_description=False)
    return p.select("vacancy_id", S.flag_regex("schedule").alias("is_remote"))


def _band_sql(x, cuts, labels):
    whens = " ".join(f"WHEN {x} < {c} THEN '{lab}'" for c, lab in zip(cuts, labels))
    return f"CASE WHEN {x} IS NULL THEN NULL {whens} ELSE '{labels[len(cuts)]}' END"


@register("c17_band", "SELECT event_id, " + _band_sql("value", [0, 10, 20], K.GAP_BANDS[1]) + " AS gap_status, "
          + _band_sql("value", [25, 50, 75], K.PERCENTILE_BANDS[1]) + " AS percentile_band FROM events")
def c17(spark, d):
    ev = read_table(spark, d, "events")
    return ev.select("event_id", S.band("value", *K.GAP_BANDS).alias("gap_status"),
                     S.band("value", *K.PERCENTILE_BANDS).alias("percentile_band"))


@register("c18_truncate_label", with_ctes(
    "SELECT vacancy_id, CASE WHEN length(name) > 40 THEN substr(name, 1, 37) || '...' ELSE name END AS title FROM postings",
    processed=False))
def c18(spark, d):
    p = postings(spark, d, with_description=False)
    return p.select("vacancy_id", S.truncate_label("name", 40).alias("title"))


@register("c19_format_amount", "SELECT event_id, replace(format('{:,}', CAST(round_even(value * 1000, 0) AS BIGINT)), ',', ' ') "
          "AS amount_text FROM events")
def c19(spark, d):
    ev = read_table(spark, d, "events")
    return ev.select("event_id", S.format_amount(F.col("value") * 1000).alias("amount_text"))


@register("c20_parse_skill_input", with_ctes(
    "SELECT vacancy_id, array_to_string(list_filter(list_transform(string_split(lower(trim(array_to_string(skills_all, ', '))), ','), "
    "lambda x: replace(trim(x), ' ', '_')), lambda x: x <> ''), '|') AS parsed FROM processed"))
def c20(spark, d):
    p = PP.processed_postings(spark, d, winsorise=False)
    return p.select("vacancy_id", F.array_join(T.parse_skill_input(F.array_join("skills_all", ", ")), "|").alias("parsed"))


def _vocab_sql():
    return "[" + ", ".join("'" + s + "'" for s in K.ADVISOR_TAUGHT) + "]"


@register("c21_partition_by_vocab", with_ctes(
    f"SELECT vacancy_id, array_to_string(list_filter(skill_slugs, lambda x: list_contains({_vocab_sql()}, x)), '|') AS recognised, "
    f"array_to_string(list_filter(skill_slugs, lambda x: NOT list_contains({_vocab_sql()}, x)), '|') AS unrecognised FROM processed"))
def c21(spark, d):
    p = PP.processed_postings(spark, d, winsorise=False)
    v = T.str_array(K.ADVISOR_TAUGHT)
    return p.select("vacancy_id", F.array_join(T.in_vocab(F.col("skill_slugs"), v), "|").alias("recognised"),
                    F.array_join(T.not_in_vocab(F.col("skill_slugs"), v), "|").alias("unrecognised"))


@register("c24_lookup_default", with_ctes(
    "SELECT skill, coalesce(CASE skill WHEN 'redis' THEN '20' WHEN 'mongodb' THEN '30' WHEN 'elasticsearch' THEN '40' END, "
    "CASE WHEN skill IN ('docker', 'kubernetes', 'ci/cd') THEN '40-60' ELSE '30-50' END) AS hours "
    "FROM (SELECT DISTINCT skill FROM posting_skill)"))
def c24(spark, d):
    s = PP.posting_skills(spark, d).select("skill").distinct()
    return s.select("skill", S.lookup_default("skill", K.EFFORT_HOURS, [K.EFFORT_GROUP], K.EFFORT_DEFAULT).alias("hours"))


@register("c25_join_labels", with_ctes(
    "SELECT vacancy_id, array_to_string(list_transform(list_sort(skill_slugs), lambda x: replace(x, 'skill_', '')), ', ') AS labels "
    "FROM processed"))
def c25(spark, d):
    p = PP.processed_postings(spark, d, winsorise=False)
    return p.select("vacancy_id", S.join_labels("skill_slugs", sort=True).alias("labels"))


@register("c26_select_as", with_ctes(
    "SELECT vacancy_id AS id, area_normalized AS city, salary_monthly_kzt AS salary FROM processed"))
def c26(spark, d):
    p = _proc(spark, d)
    return p.select(F.col("vacancy_id").alias("id"), F.col("area_normalized").alias("city"),
                    F.col("salary_monthly_kzt").alias("salary"))


@register("c28_pct", "SELECT event_type, CAST(count(*) AS BIGINT) AS n, round(100.0 * count(*) / (SELECT count(*) FROM events), 6) AS pct "
          "FROM events GROUP BY event_type")
def c28(spark, d):
    ev = read_table(spark, d, "events")
    tot = ev.agg(F.count(F.lit(1)).alias("_t"))
    g = ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return g.crossJoin(F.broadcast(tot)).select("event_type", "n", rnd(S.pct("n", "_t"), 6).alias("pct"))


# ------------------------------------------------------------------ P-series

@register("p01_profile_extent", with_ctes(
    "SELECT count(*) AS n_rows, strftime(min(published_at), '%Y-%m-%d') AS first_ts, "
    "strftime(max(published_at), '%Y-%m-%d') AS last_ts, CAST(15 AS BIGINT) AS n_columns FROM postings", processed=False))
def p01(spark, d):
    p = postings(spark, d, with_description=True)
    r = P.profile_extent(p, "published_at")
    return r.select("n_rows", F.date_format("first_ts", "yyyy-MM-dd").alias("first_ts"),
                    F.date_format("last_ts", "yyyy-MM-dd").alias("last_ts"), "n_columns")


_POSTING_COLS = ["vacancy_id", "name", "area", "salary_from", "salary_to", "salary_currency", "experience",
                 "schedule", "employment", "description", "key_skills", "employer_name", "url"]


@register("p02_profile_columns", with_ctes(
    "SELECT col AS column, CAST(nn AS BIGINT) AS non_null, CASE col WHEN 'vacancy_id' THEN 'bigint' WHEN 'salary_from' THEN 'double' "
    "WHEN 'salary_to' THEN 'double' ELSE 'string' END AS dtype FROM (UNPIVOT (SELECT " +
    ", ".join(f"count({c}) AS {c}" for c in _POSTING_COLS) + " FROM postings) ON COLUMNS(*) INTO NAME col VALUE nn)",
    processed=False))
def p02(spark, d):
    p = postings(spark, d, with_description=True).select(*_POSTING_COLS)
    return P.profile_columns(p).select("column", "non_null", "dtype")


@register("p03_describe_numeric", "SELECT column_name, count, round(mean, 6) AS mean, round(std, 6) AS std, round(min, 6) AS min, "
          "round(q25, 6) AS q25, round(q50, 6) AS q50, round(q75, 6) AS q75, round(max, 6) AS max FROM ("
          "SELECT col AS column_name, count(v) AS count, avg(v) AS mean, stddev_samp(v) AS std, min(v) AS min, "
          "quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50, quantile_cont(v, 0.75) AS q75, max(v) AS max FROM "
          "(UNPIVOT (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem) ON COLUMNS(*) INTO NAME col VALUE v) "
          "GROUP BY col)")
def p03(spark, d):
    li = read_table(spark, d, "lineitem")
    r = P.describe_numeric(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return r.select(F.col("column").alias("column_name"), "count", *[rnd(c, 6).alias(c) for c in ["mean", "std", "min", "q25", "q50", "q75", "max"]])


@register("p04_missing_report", with_ctes(
    "SELECT col AS column, CAST(m AS BIGINT) AS missing, round(100.0 * m / n, 6) AS missing_pct FROM (UNPIVOT (SELECT " +
    ", ".join(f"count(*) - count({c}) AS {c}" for c in _POSTING_COLS) +
    ", count(*) AS n FROM postings) ON COLUMNS(* EXCLUDE (n)) INTO NAME col VALUE m) WHERE m > 0", processed=False))
def p04(spark, d):
    p = postings(spark, d, with_description=True).select(*_POSTING_COLS)
    r = P.missing_report(p)
    return r.select("column", "missing", rnd("missing_pct", 6).alias("missing_pct"))


@register("p05_value_counts", with_ctes(
    "SELECT area_normalized, count(*) AS count FROM processed0 WHERE area_normalized IS NOT NULL GROUP BY 1"))
def p05(spark, d):
    p = PP.normalize_locations(postings(spark, d, with_description=False))
    return P.value_counts(p, "area_normalized")


@register("p06_code_crosswalk", with_ctes(
    "SELECT experience, CAST(min(experience_level) AS BIGINT) AS experience_level, count(vacancy_id) AS count "
    "FROM processed0 WHERE experience IS NOT NULL GROUP BY experience"))
def p06(spark, d):
    p = PP.encode_experience(postings(spark, d, with_description=False))
    r = P.code_crosswalk(p, "experience", "experience_level", "vacancy_id")
    return r.select("experience", big("experience_level").alias("experience_level"), "count")


@register("p07_coverage_stats", with_ctes(
    "SELECT count(salary_raw_kzt) AS n_with, count(*) - count(salary_raw_kzt) AS n_without, "
    "round(100.0 * count(salary_raw_kzt) / count(*), 6) AS pct_with, round(min(salary_raw_kzt), 2) AS min, "
    "round(max(salary_raw_kzt), 2) AS max, round(avg(salary_raw_kzt), 2) AS mean, "
    "round(quantile_cont(salary_raw_kzt, 0.5), 2) AS median FROM processed0"))
def p07(spark, d):
    p = PP.clean_salaries(postings(spark, d, with_description=False), out="salary_raw_kzt")
    r = P.coverage_stats(p, "salary_raw_kzt")
    return r.select("n_with", "n_without", rnd("pct_with", 6).alias("pct_with"),
                    *[rnd(c).alias(c) for c in ["min", "max", "mean", "median"]])


@register("p08_array_coverage", with_ctes(
    "SELECT CAST(sum(len(skills_all)) AS BIGINT) AS total_items, round(avg(len(skills_all)), 6) AS mean_items, "
    "count_if(len(skills_all) > 0) AS rows_with_items, round(100.0 * count_if(len(skills_all) > 0) / count(*), 6) AS pct_with_items "
    "FROM processed"))
def p08(spark, d):
    p = PP.processed_postings(spark, d, winsorise=False)
    r = P.array_coverage(p, "skills_all")
    return r.select("total_items", rnd("mean_items", 6).alias("mean_items"), "rows_with_items",
                    rnd("pct_with_items", 6).alias("pct_with_items"))


@register("p09_pipeline_summary", with_ctes(
    "SELECT (SELECT count(*) FROM postings) AS rows_before, (SELECT count(*) FROM processed) AS rows_after, "
    "CAST(15 AS BIGINT) AS columns_before, CAST(23 AS BIGINT) AS columns_after"))
def p09(spark, d):
    before = postings(spark, d, with_description=True)
    after = PP.processed_postings(spark, d, with_description=True)
    return P.pipeline_summary(before, after)


@register("p10_target_split_stats", with_ctes(
    "SELECT count(salary_monthly_kzt) AS n_with, count(*) - count(salary_monthly_kzt) AS n_without, "
    "round(100.0 * count(salary_monthly_kzt) / count(*), 6) AS pct_with, "
    "round(100.0 * (count(*) - count(salary_monthly_kzt)) / count(*), 6) AS pct_without FROM processed"))
def p10(spark, d):
    r = P.target_split_stats(_proc(spark, d), "salary_monthly_kzt")
    return r.select("n_with", "n_without", rnd("pct_with", 6).alias("pct_with"), rnd("pct_without", 6).alias("pct_without"))
