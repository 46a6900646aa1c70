"""Queries: sources/sinks (S-series), streaming landing (ST1) and chart
tables (V-series).  File round trips write under the shared checkpoint
folder (``spark.checkpoint.dir``), each run to a fresh path."""
from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..operators import aggregates as A
from ..functions import tails as TL
from ..operators import charts as V
from ..operators import skills as SK
from ..sources import files as FS
from ..sources.adapter import postings
from ..sources.tables import read_table
from ..session import scratch_path
from ..streaming.landing import land_stream, read_landed
from . import preprocess as PP
from .catalog import register, rnd, with_ctes
from .q_models import _model, feature_frame
from .preprocess import city_sql
from .q_stats import _TOP50_SQL, MAJOR_SQL, Y, _gs_sql, proc, skill_rows

_FLAT_COLS = ["name", "area", "salary_from", "salary_to", "salary_currency", "experience", "schedule", "key_skills"]
_FLAT_SQL = with_ctes("SELECT vacancy_id, " + ", ".join(_FLAT_COLS) + ", CAST(length(description) AS BIGINT) AS desc_chars "
                      "FROM postings", processed=False)


def _flat_out(df):
    return df.select(F.col("vacancy_id").cast("bigint").alias("vacancy_id"), *_FLAT_COLS,
                     F.length("description").cast("bigint").alias("desc_chars"))


def _flat_postings(spark, d):
    p = postings(spark, d, with_description=True)
    return p.select(F.col("vacancy_id").cast("string").alias("vacancy_id"), "name", "area", "salary_from", "salary_to",
                    "salary_currency", "experience", "schedule", "employment", "description", "key_skills",
                    "employer_name", F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss").alias("published_at"), "url")


@register("s01_read_csv", _FLAT_SQL)
def s01(spark, d):
    path = scratch_path(spark, "postings-csv")
    FS.write_csv(_flat_postings(spark, d), path)
    return _flat_out(FS.read_postings_csv(spark, path))


# Flattening joins the key-skill names with ', ', so a posting without key
# skills comes back as '' (an empty list), not null.
_FLAT_JSON_SQL = _FLAT_SQL.replace("experience, schedule, key_skills,", "experience, schedule, coalesce(key_skills, '') AS key_skills,")


@register("s02_read_json", _FLAT_JSON_SQL)
def s02(spark, d):
    path = scratch_path(spark, "postings-json")
    FS.write_json(FS.nest_postings(_flat_postings(spark, d)), path)
    return _flat_out(FS.flatten_postings(FS.read_postings_json(spark, path)))


@register("s03_flatten_postings", _FLAT_JSON_SQL)
def s03(spark, d):
    return _flat_out(FS.flatten_postings(FS.nest_postings(_flat_postings(spark, d))))


_CONTENT_SQL = with_ctes(
    "SELECT p.vacancy_id, p.name, p.area, p.salary_from, round(p.salary_monthly_kzt, 4) AS salary, "
    "array_to_string(p.skill_slugs, '|') AS slugs, CAST(length(d.text) AS BIGINT) AS desc_chars, md5(d.text) AS desc_md5 "
    "FROM processed p LEFT JOIN documents d ON d.doc_id = p.doc_id")


def _content(back):
    return back.select(F.col("vacancy_id").cast("bigint").alias("vacancy_id"), "name", "area",
                       F.col("salary_from").cast("double").alias("salary_from"), rnd(F.col(Y).cast("double"), 4).alias("salary"),
                       F.array_join("skill_slugs", "|").alias("slugs"), F.length("description").cast("bigint").alias("desc_chars"),
                       F.md5("description").alias("desc_md5"))


@register("s04_write_csv", _CONTENT_SQL)
def s04(spark, d):
    """Written, read back, and compared by content, texts with line breaks
    and quotes included."""
    path = scratch_path(spark, "processed-csv")
    FS.write_csv(PP.processed_postings(spark, d, with_description=True), path)
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return _content(back.withColumn("skill_slugs", F.from_json("skill_slugs", "array<string>")))


@register("s05_write_json", _CONTENT_SQL)
def s05(spark, d):
    path = scratch_path(spark, "processed-json")
    p = PP.processed_postings(spark, d, with_description=True)
    FS.write_json(p, path)
    return _content(spark.read.schema(p.schema).json(path))


@register("s06_write_stage", with_ctes(
    "SELECT vacancy_id, CAST(len(skill_slugs) AS BIGINT) AS n_skills, salary_monthly_kzt AS salary FROM processed"))
def s06(spark, d):
    path = scratch_path(spark, "processed-parquet")
    FS.write_stage(PP.processed_postings(spark, d), path)
    back = spark.read.parquet(path)
    return back.select("vacancy_id", F.size("skill_slugs").cast("bigint").alias("n_skills"), F.col(Y).alias("salary"))


@register("s07_dedupe_postings", with_ctes(
    "SELECT vacancy_id, area, CASE WHEN " + city_sql("area") + " = 'Astana' THEN 'renewed ' ELSE '' END || name AS name FROM postings",
    processed=False))
def s07(spark, d):
    """Overlapping page fetches deduplicated on the id, keeping the latest
    publication: Almaty postings come again with an older date and another
    name, Astana ones with a newer date and another name."""
    p = postings(spark, d, with_description=False).select("vacancy_id", "area", F.col("published_at").cast("timestamp").alias("published_at"), "name")
    city = PP.normalize_locations(p)
    older = city.where(F.col("area_normalized") == "Almaty").select(
        "vacancy_id", "area", (F.col("published_at") - F.expr("INTERVAL 1 DAY")).alias("published_at"), F.concat(F.lit("stale "), "name").alias("name"))
    newer = city.where(F.col("area_normalized") == "Astana").select(
        "vacancy_id", "area", (F.col("published_at") + F.expr("INTERVAL 1 DAY")).alias("published_at"), F.concat(F.lit("renewed "), "name").alias("name"))
    pages = newer.unionByName(p).unionByName(older)
    return FS.dedupe_postings(pages, "vacancy_id", latest="published_at").select("vacancy_id", "area", "name")


_EVENT_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.StringType()),
                              T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
                              T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


@register("st01_land_stream", "SELECT event_id, event_type, value FROM events")
def st01(spark, d):
    """Events land in three runs of the stream, restarted from its
    checkpoint: two thirds of them, clicks twice (the older copy with
    another value); then the last third, dated years back, with clicks that
    have landed again; then everything once more in another order.  One row
    per event id stays, and none is lost for being late."""
    in_dir, out_dir, ck = scratch_path(spark, "landing-in"), scratch_path(spark, "landing-out"), scratch_path(spark, "landing-ck")
    ev = read_table(spark, d, "events")
    click, late = F.col("event_type") == "click", F.pmod("event_id", F.lit(3)) == 0

    def land(rows, files):
        rows = rows.withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        rows.repartition(files).write.mode("append").json(in_dir)
        land_stream(spark, in_dir, out_dir, ck, _EVENT_SCHEMA, "event_id", "ts")

    stale = ev.where(click).withColumn("ts", F.col("ts") - F.expr("INTERVAL 1 DAY")).withColumn("value", F.lit(-1.0))
    land(stale.where(~late).unionByName(ev.where(~late)), 4)
    land(ev.where(late).withColumn("ts", F.col("ts") - F.expr("INTERVAL 14 YEAR")).unionByName(stale.where(~late)), 3)
    land(ev.orderBy(F.desc("event_id")).withColumn("value", F.lit(-2.0)), 2)
    return read_landed(spark, out_dir).select("event_id", "event_type", "value")


# ------------------------------------------------------------------ V-series

@register("v01_histogram", "WITH r AS (SELECT min(value) AS lo, max(value) AS hi FROM events), "
          "b AS (SELECT CAST(CASE WHEN (hi - lo) / 50 > 0 THEN least(floor((value - lo) / ((hi - lo) / 50)), 49) ELSE 0 END AS INT) AS bin, "
          "lo, hi FROM events CROSS JOIN r WHERE value IS NOT NULL) "
          "SELECT bin, round(lo + bin * ((hi - lo) / 50), 6) AS bin_lo, round(lo + (bin + 1) * ((hi - lo) / 50), 6) AS bin_hi, "
          "count(*) AS count FROM b GROUP BY bin, lo, hi")
def v01(spark, d):
    h = V.histogram(read_table(spark, d, "events"), "value", 50)
    return h.select("bin", rnd("bin_lo", 6).alias("bin_lo"), rnd("bin_hi", 6).alias("bin_hi"), "count")


_BOX_SQL = with_ctes(
    "WITH d AS (SELECT area_normalized AS g, salary_raw_kzt AS y FROM processed WHERE salary_raw_kzt IS NOT NULL), "
    "q AS (SELECT g, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.5) AS median, quantile_cont(y, 0.75) AS q3 FROM d GROUP BY g), "
    "f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS uf FROM q) "
    "SELECT g AS area_normalized, round(q1, 2) AS q1, round(median, 2) AS median, round(q3, 2) AS q3, "
    "round(min(CASE WHEN y >= lf AND y <= uf THEN y END), 2) AS whisker_lo, round(max(CASE WHEN y >= lf AND y <= uf THEN y END), 2) AS whisker_hi, "
    "count_if(NOT (y >= lf AND y <= uf)) AS n_outliers, count(*) AS n FROM d JOIN f USING (g) GROUP BY g, q1, median, q3")


@register("v02_box_stats", _BOX_SQL)
def v02(spark, d):
    b = V.box_stats(proc(spark, d), "area_normalized", "salary_raw_kzt")
    return b.select("area_normalized", *[rnd(c).alias(c) for c in ["q1", "median", "q3", "whisker_lo", "whisker_hi"]],
                    "n_outliers", "n")


def _poly_sql(x, cs):
    out = f"({cs[0]!r})"
    for c in cs[1:]:
        out = f"({out} * {x} + ({c!r}))"
    return out


def _ppf_sql(p):
    """The normal quantile by the same rational approximations."""
    q, r = f"({p} - 0.5)", f"sqrt(-ln(least({p}, 1.0 - {p})))"

    def ratio(x, tables):
        return f"({_poly_sql(x, tables[0])} / {_poly_sql(x, tables[1])})"

    tail = f"(CASE WHEN {r} <= 5 THEN {ratio(f'({r} - 1.6)', TL.PPF_TAIL)} ELSE {ratio(f'({r} - 5.0)', TL.PPF_FAR)} END)"
    return f"CASE WHEN abs({q}) <= 0.425 THEN {q} * {ratio(f'(0.180625 - {q} * {q})', TL.PPF_MIDDLE)} ELSE sign({q}) * {tail} END"


_QQ_SQL = with_ctes(
    "WITH o AS (SELECT salary_monthly_kzt AS y, row_number() OVER (ORDER BY salary_monthly_kzt) AS i, count(*) OVER () AS n "
    "FROM processed WHERE salary_monthly_kzt IS NOT NULL), "
    "m AS (SELECT y, i, CASE WHEN i = n THEN pow(0.5, 1.0 / n) WHEN i = 1 THEN 1 - pow(0.5, 1.0 / n) ELSE (i - 0.3175) / (n + 0.365) END AS m FROM o), "
    f"p AS (SELECT y, i, {_ppf_sql('m')} AS x FROM m) "
    "SELECT round(y, 6) AS ordered, round(x, 6) AS theoretical, CAST(i AS BIGINT) AS position, "
    "round(regr_slope(y, x) OVER (), 2) AS slope, round(regr_intercept(y, x) OVER (), 2) AS intercept FROM p")


@register("v03_qq_points", _QQ_SQL)
def v03(spark, d):
    q = V.qq_points(proc(spark, d), Y)
    return q.select(rnd("ordered", 6).alias("ordered"), rnd("theoretical", 6).alias("theoretical"),
                    F.col("position").cast("bigint").alias("position"), rnd("slope").alias("slope"), rnd("intercept").alias("intercept"))


_KDE_SQL = with_ctes(
    "WITH d AS (SELECT area_normalized AS g, salary_raw_kzt AS y FROM processed WHERE salary_raw_kzt IS NOT NULL), "
    "s AS (SELECT g, count(*) AS n, stddev_samp(y) * pow(count(*), -0.2) AS h, min(y) AS lo, max(y) AS hi FROM d GROUP BY g), "
    "grid AS (SELECT range AS gi FROM range(0, 50)), "
    "k AS (SELECT d.g, gi, s.n, s.h, s.lo, s.hi, sum(exp(-0.5 * pow((s.lo + gi * (s.hi - s.lo) / 49 - d.y) / s.h, 2))) AS kk "
    "FROM d JOIN s USING (g) CROSS JOIN grid WHERE s.h > 0 GROUP BY d.g, gi, s.n, s.h, s.lo, s.hi) "
    "SELECT g AS area_normalized, CAST(gi AS INT) AS g, round(lo + gi * (hi - lo) / 49, 4) AS x, "
    "round(kk / (n * h * sqrt(2 * pi())) * 1e9, 3) AS density_e9 FROM k")


@register("v04_density_curve", _KDE_SQL)
def v04(spark, d):
    k = V.density_curve(proc(spark, d), "area_normalized", "salary_raw_kzt", 50)
    return k.select("area_normalized", F.col("g").cast("int").alias("g"), rnd("x", 4).alias("x"),
                    rnd(F.col("density") * 1e9, 3).alias("density_e9"))


@register("v05_mean_sd_series", with_ctes(
    "WITH s AS (" + _gs_sql("area_normalized", "processed", ("count", "mean", "median", "std")) + ") "
    "SELECT area_normalized, mean, median, mean - std AS mean_minus_sd, mean + std AS mean_plus_sd, "
    "mean - median AS mean_minus_median FROM s"))
def v05(spark, d):
    s = A.group_stats(proc(spark, d), "area_normalized", Y, ("count", "mean", "median", "std"), sort=False)
    return V.mean_sd_series(s, "area_normalized")


@register("v06_residual_points")
def v06(spark, d):
    """Predicted vs actual and residual for the test rows (ridge)."""
    f, _ = feature_frame(spark, d)
    pred = _model(spark, d, "ridge").transform(f.where(~F.col("is_train") & F.col(Y).isNotNull()))
    return pred.select("vacancy_id", F.col(Y).alias("actual"), F.col("prediction").alias("predicted"),
                       (F.col(Y) - F.col("prediction")).alias("residual"))


# V7: the correlation table and the rates by area in heat-map shape; the
# region x skill matrix (A11) is the third.

_RATE_SQL = ("WITH sz AS (SELECT area_normalized, count(*) AS size FROM processed GROUP BY 1), "
             f"k AS (SELECT p.area_normalized, ps.skill, count(*) AS k FROM posting_skill ps JOIN {_TOP50_SQL} t USING (skill) "
             "JOIN processed p USING (vacancy_id) GROUP BY 1, 2) SELECT skill, "
             + ", ".join(f"round(max(CASE WHEN area_normalized = '{c}' THEN k / size END), 6) AS \"{c}\"" for c in K.MAJOR_CITIES)
             + f" FROM k JOIN sz USING (area_normalized) WHERE area_normalized IN {MAJOR_SQL} GROUP BY skill")


@register("v07_heatmap_matrix", with_ctes(_RATE_SQL))
def v07(spark, d):
    p = skill_rows(spark, d, salary=False)
    r = SK.indicator_rates(p, "area_normalized", SK.top_items(PP.skill_long(p), K.TOP_N_SKILLS))
    r = r.where(F.col("area_normalized").isin(K.MAJOR_CITIES))
    return A.pivot_matrix(r, "skill", "area_normalized", "rate", K.MAJOR_CITIES, digits=6)
