"""Batch career advisor (B-series): one row per profile, any number of
profiles.

Coefficients, premiums and demand of the models' feature skills (at most 50,
which is asserted) are folded into a one-row table and crossed with the
profiles; every profile is then scored with array higher-order functions in
its own row: no shuffle by user, no profile x skill pair table.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import scalar as S
from ..functions import text as T


def profiles_from_postings(p: DataFrame) -> DataFrame:
    """Profiles derived from postings: skills text, level and city."""
    return p.select(F.col("vacancy_id").alias("user_id"), F.array_join("skills_all", ", ").alias("skills_text"),
                    "experience_level", F.col("area_normalized").alias("city"))


def with_valid_skills(profiles: DataFrame, feature_skills: DataFrame, item: str = "skill") -> DataFrame:
    """C20 + C21: parse the text; keep (distinct) skills that are model
    features; the rest are unrecognised."""
    vocab = feature_skills.agg(F.collect_set(item).alias("_vocab"))
    parsed = T.parse_skill_input("skills_text")
    j = profiles.crossJoin(F.broadcast(vocab))
    return j.select("*", F.array_distinct(T.in_vocab(parsed, F.col("_vocab"))).alias("skills"),
                    T.not_in_vocab(parsed, F.col("_vocab")).alias("unrecognised")).drop("_vocab")


def curriculum_status(skill) -> F.Column:
    """Taught / gap / other by the lower-cased, '_'-joined skill."""
    s = F.replace(F.lower(skill if not isinstance(skill, str) else F.col(skill)), F.lit(" "), F.lit("_"))
    return (F.when(s.isin(K.ADVISOR_TAUGHT), F.lit("taught"))
            .when(s.isin(K.CRITICAL_GAPS), F.lit("gap")).otherwise(F.lit("other")))


def market_list(premiums: DataFrame, demand: DataFrame | None = None, most: int = K.TOP_N_SKILLS) -> DataFrame:
    """One row: the feature skills by premium (highest first, ties by name)
    as an array of structs with premium, market frequency (0 when unknown),
    tier and curriculum status, made once for all profiles.  ``premiums``
    must hold the models' feature skills only; more than ``most`` is an
    error, so the row that is broadcast is bounded."""
    p = premiums.select("skill", "premium")
    if demand is not None:
        p = p.join(demand.select(F.col("slug").alias("skill"), "market_pct"), "skill", "left")
    freq = F.coalesce("market_pct", F.lit(0.0)) if demand is not None else F.lit(0.0)
    x = F.struct((-F.col("premium")).alias("order"), "skill", "premium", freq.alias("frequency"),
                 S.band("premium", *K.PREMIUM_BANDS).alias("tier"), curriculum_status(F.col("skill")).alias("status"))
    one = p.agg(F.sort_array(F.collect_list(x)).alias("_market"), F.count(F.lit(1)).alias("_k"))
    return one.select(F.when(F.col("_k") <= most, F.col("_market")).otherwise(
        F.raise_error(F.lit(f"more than {most} feature skills")).cast(one.schema["_market"].dataType)).alias("_market"))


def _held(x):
    return F.array_contains("skills", x["skill"])


def skill_breakdown(prof: DataFrame, market: DataFrame) -> DataFrame:
    """B4 (+J1, A19): the profile's skills that have a premium, with premium
    and curriculum status; one row per (user, skill)."""
    j = prof.select("user_id", "skills").crossJoin(F.broadcast(market))
    e = j.select("user_id", F.posexplode(F.filter("_market", _held)).alias("pos", "m"))
    return e.select("user_id", "m.skill", "m.premium", "m.status", (F.col("pos") + 1).alias("rank"))


def total_premium(prof: DataFrame, market: DataFrame) -> DataFrame:
    """Sum of premiums of the skills held, per profile (in-row)."""
    j = prof.select("user_id", "skills").crossJoin(F.broadcast(market))
    held = F.filter("_market", _held)
    return j.select("user_id", F.size(held).cast("bigint").alias("n_with_premium"),
                    F.aggregate(held, F.lit(0.0), lambda a, x: a + x["premium"]).alias("total_premium"))


def path_table(spark, paths=K.CAREER_PATHS) -> DataFrame:
    """(path, needs): a row per path with its distinct skills."""
    return spark.createDataFrame([(n, list(dict.fromkeys(ls))) for n, ls in paths], "path string, needs array<string>")


def career_path(prof: DataFrame, paths: DataFrame | None = None, default: str = K.CAREER_PATH_DEFAULT, broadcast_rows: int = 100_000) -> DataFrame:
    """Share of each path's list held, for any number of paths; a path
    wins only when its share is strictly greater than every other's, else
    the default; with have / to-master lists (B7).

    The paths' skills are an inverted index, skill -> paths; a profile meets
    only the paths that need one of its skills, and its counts are summed
    per path.  A profile that meets none has share 0 for all.  The index is
    broadcast if it is counted to be small.  Profiles are rows of their own;
    a path's list holds each skill once."""
    if paths is None:
        paths = path_table(prof.sparkSession)
    index = paths.select("path", F.size("needs").alias("size"), F.explode(F.array_distinct("needs")).alias("skill"))
    few = index.limit(broadcast_rows + 1).count() <= broadcast_rows
    p = prof.select("user_id", "skills").withColumn("_row", F.monotonically_increasing_id())
    met = p.select("_row", F.explode(F.array_distinct("skills")).alias("skill")).join(F.broadcast(index) if few else index, "skill")
    share = met.groupBy("_row", "path", "size").agg((F.count(F.lit(1)) / F.col("size") * 100.0).alias("share"))
    # the best share is one path's if its first and its last path by name are the same
    best = share.groupBy("_row").agg(F.max_by("path", F.struct("share", "path")).alias("_last"),
                                     F.min_by("path", F.struct(-F.col("share"), F.col("path"))).alias("_first"))
    best = best.select("_row", F.when(F.col("_last") == F.col("_first"), F.col("_last")).alias("_won"))
    named = p.join(best, "_row", "left").withColumn("path", F.coalesce("_won", F.lit(default))).drop("_won")
    full = paths.select("path", "needs")
    w = named.join(F.broadcast(full) if few else full, "path", "left")
    held = F.size(F.array_intersect("skills", "needs"))
    return w.select(
        "user_id", "path", (held / F.size("needs") * 100.0).alias("match_pct"),
        F.array_join(F.filter("skills", lambda s: F.array_contains("needs", s)), "|").alias("have"),
        F.array_join(F.filter("needs", lambda s: ~F.array_contains("skills", s)), "|").alias("to_master"))


def recommend_skills(prof: DataFrame, market: DataFrame, k: int = 15) -> DataFrame:
    """B8 (+J2, J3, C17): the k highest-premium skills the profile lacks,
    with market frequency, tier and curriculum status."""
    j = prof.select("user_id", "skills").crossJoin(F.broadcast(market))
    lacking = F.slice(F.filter("_market", lambda x: ~_held(x)), 1, k)
    # outer, as Spark makes the list twice for an inner one: once for its size
    e = j.select("user_id", F.posexplode_outer(lacking).alias("pos", "m")).where(F.col("pos").isNotNull())
    return e.select("user_id", (F.col("pos") + 1).alias("rank"), "m.skill", "m.premium", "m.frequency", "m.tier", "m.status")


def critical_gaps(prof: DataFrame, market: DataFrame) -> DataFrame:
    """Critical-gap skills the profile lacks that have a premium, with
    premium and demand (no premium -> not listed)."""
    j = prof.select("user_id", "skills").crossJoin(F.broadcast(market))
    gaps = F.filter("_market", lambda x: x["skill"].isin(K.CRITICAL_GAPS) & ~_held(x))
    return j.select("user_id", F.explode(gaps).alias("m")).select("user_id", "m.skill", "m.premium", "m.frequency")


def curriculum_todo(prof: DataFrame, market: DataFrame, max_n: int = 10) -> DataFrame:
    """Taught skills not mastered that have a premium, in curriculum
    order, with their number; ``shown`` is false where the study leaves the
    list out because it has more than ``max_n``."""
    j = prof.select("user_id", "skills").crossJoin(F.broadcast(market))
    order = T.str_array(K.ADVISOR_TAUGHT)
    todo = F.filter("_market", lambda x: F.array_contains(order, x["skill"]) & ~_held(x))
    todo = F.array_sort(F.transform(todo, lambda x: F.struct(F.array_position(order, x["skill"]).alias("at"), x["skill"].alias("skill"),
                                                             x["premium"].alias("premium"))))
    e = j.select("user_id", todo.alias("_todo")).select("user_id", F.size("_todo").cast("bigint").alias("n_todo"),
                                                        F.posexplode("_todo").alias("pos", "m"))
    return e.select("user_id", (F.col("pos") + 1).alias("rank"), "m.skill", "m.premium", "n_todo",
                    (F.col("n_todo") <= max_n).alias("shown"))


def action_plan(recs: DataFrame, n: int = 3) -> DataFrame:
    """The first n recommendations with their self-study hours."""
    s = F.replace(F.lower(F.col("skill")), F.lit(" "), F.lit("_"))
    return recs.where(F.col("rank") <= n).select(
        "user_id", "rank", "skill", "premium", "status",
        S.lookup_default(s, K.EFFORT_HOURS, [K.EFFORT_GROUP], K.EFFORT_DEFAULT).alias("hours"))


def linear_scores(prof: DataFrame, coef: DataFrame, intercept: float, level_coef_name: str = "experience_level",
                  area_prefix: str = "area_normalized_") -> DataFrame:
    """B1 + B3: prediction of a linear model from the profile's skills,
    level and city, as in-row sums over a one-row coefficient map; plus the
    what-if one level up (none at the top level)."""
    cm = coef.agg(F.map_from_entries(F.collect_list(F.struct("name", "coefficient"))).alias("_cm"))
    j = prof.crossJoin(F.broadcast(cm))
    skill_sum = F.aggregate(F.transform("skills", lambda s: F.coalesce(F.element_at("_cm", F.concat(F.lit("skill_"), s)),
                                                                          F.lit(0.0))), F.lit(0.0), lambda a, b: a + b)
    lvl = F.coalesce(F.element_at("_cm", F.lit(level_coef_name)), F.lit(0.0))
    area = F.coalesce(F.element_at("_cm", F.concat(F.lit(area_prefix), F.col("city"))), F.lit(0.0))
    pred = F.lit(float(intercept)) + skill_sum + lvl * F.col("experience_level") + area
    nxt = F.when(F.col("experience_level") < 3, pred + lvl)
    return j.select("user_id", "experience_level", "city", pred.alias("predicted_salary"),
                    nxt.alias("next_level_salary"), (nxt - pred).alias("level_gain"),
                    S.pct(nxt - pred, pred).alias("level_gain_pct"))
