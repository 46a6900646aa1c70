"""The cleaning chain as one lazy plan.

salary -> place -> experience -> skill tagging -> long skill table ->
winsorised salary.  The two global facts it needs (IQR bounds, top-N skills)
are one-row / N-row aggregates joined back by broadcast, so the whole chain
is a single job per action.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import scalar as S
from ..functions import text as T
from ..operators.quantiles import quantiles
from ..sources.adapter import postings
from ..session import stage
from ..sources.tables import read_table
from .build import build_cache


def clean_salaries(df: DataFrame, rules=K.CURRENCY_RULES, out: str = "salary_monthly_kzt") -> DataFrame:
    return df.withColumn(out, S.to_base_currency(S.range_midpoint("salary_from", "salary_to"), "salary_currency", rules))


def normalize_locations(df: DataFrame, rules=K.CITY_RULES, col: str = "area") -> DataFrame:
    return df.withColumn("area_normalized", S.normalize_category(col, rules))


def encode_experience(df: DataFrame, mapping=K.EXPERIENCE_LEVELS, col: str = "experience") -> DataFrame:
    return df.withColumn("experience_level", S.encode_ordinal(col, mapping, 0))


def tag_texts(df: DataFrame, text: str, out: str = "skills_extracted", vocab=K.TECH_TERMS,
              boundary: str = "token") -> DataFrame:
    """Tag whole texts; the word split is made once per row.  It is bound to a
    variable, not a column: a filter on the tags that Spark moves below a
    column would hold a copy of the split for every term."""
    if boundary != "token":
        return df.withColumn(out, T.tag_terms(text, vocab, boundary))

    def tags(low):
        return _bound(T.word_hits(low, vocab, lowered=True),
                      lambda hits: T.tag_terms(low, vocab, boundary, hits=hits, lowered=True))
    return df.withColumn(out, F.coalesce(_bound(F.lower(F.col(text)), tags), F.array().cast("array<string>")))


def _bound(value, body):
    """``body`` of the value, which is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def extract_skills(df: DataFrame, text: str | None = "description", tags: DataFrame | None = None,
                   tag_key: str = "doc_id", vocab=K.TECH_TERMS, boundary: str = "token") -> DataFrame:
    """skills_extracted (dictionary terms in the text), skills_key_parsed
    (list text), skills_all (distinct union), skill_slugs (distinct slugs).

    ``tags``: a table (tag_key, skills_extracted) computed once per distinct
    text; postings join it instead of re-scanning a shared text."""
    none = F.array().cast("array<string>")
    if tags is not None:
        tags = tags.select(tag_key, "skills_extracted", F.transform("skills_extracted", S.slug).alias("_slugs"))
        df = df.join(tags, tag_key, "left").withColumns(
            {c: F.coalesce(c, none) for c in ("skills_extracted", "_slugs")})
    else:
        df = tag_texts(df, text, "skills_extracted", vocab, boundary).withColumn("_slugs", F.transform("skills_extracted", S.slug))
    df = df.withColumn("skills_key_parsed", T.parse_list_text("key_skills"))
    df = df.withColumn("skills_all", T.merge_arrays(F.col("skills_extracted"), F.col("skills_key_parsed")))
    slugs = F.array_union("_slugs", F.transform("skills_key_parsed", S.slug))
    return df.withColumn("skill_slugs", F.sort_array(slugs)).drop("_slugs")


def skill_long(df: DataFrame, key: str = "vacancy_id", arr: str = "skill_slugs") -> DataFrame:
    """Canonical long table (key, skill): one row per posting and distinct
    slug (the array holds each slug once)."""
    return df.select(key, F.explode(arr).alias("skill"))


def iqr_bounds(df: DataFrame, col: str, k: float = K.IQR_K, approx: bool = False) -> DataFrame:
    q = quantiles(df, [], col, {"q1": 0.25, "q3": 0.75}, approx=approx)
    iqr = F.col("q3") - F.col("q1")
    return q.select("q1", "q3", (F.col("q1") - k * iqr).alias("lower_bound"), (F.col("q3") + k * iqr).alias("upper_bound"))


def winsorize(df: DataFrame, col: str, k: float = K.IQR_K, out: str | None = None, approx: bool = False) -> DataFrame:
    """Cap to the IQR fences; nulls stay null; no row dropped."""
    b = iqr_bounds(df, col, k, approx).select("lower_bound", "upper_bound")
    return (df.crossJoin(F.broadcast(b))
            .withColumn(out or col, S.cap(col, "lower_bound", "upper_bound"))
            .drop("lower_bound", "upper_bound"))


def salary_fences(spark: SparkSession, sf_dir: str, salaries: DataFrame | None = None):
    """The two IQR fences of all salaries, as literals: one row, read once
    per query build.  ``salaries``: a written table of all postings that has
    the converted salary; without one, that column is written."""
    cache = build_cache()
    if cache is not None and ("fences", sf_dir) in cache:
        return cache["fences", sf_dir]
    if salaries is None:
        p = postings(spark, sf_dir, with_description=False, with_key_skills=False)
        salaries = stage(clean_salaries(p, out="salary_raw_kzt").select("salary_raw_kzt"), "salaries")
    r = iqr_bounds(salaries, "salary_raw_kzt").first()
    got = tuple(F.lit(r[c]).cast("double") for c in ("lower_bound", "upper_bound"))
    if cache is not None:
        cache["fences", sf_dir] = got
    return got


def document_tags(spark: SparkSession, sf_dir: str, vocab=K.TECH_TERMS, boundary: str = "token") -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return tag_texts(docs, "text", "skills_extracted", vocab, boundary).select("doc_id", "skills_extracted")


def processed_postings(spark: SparkSession, sf_dir: str, winsorise: bool = True,
                       with_description: bool = False, skills: bool = True) -> DataFrame:
    """Postings after the whole cleaning chain.  ``salary_raw_kzt`` keeps the
    converted salary; ``salary_monthly_kzt`` is the winsorised one.
    ``skills=False`` leaves out the skill columns, and with them the tagging
    of the texts and the scan of the order lines."""
    p = postings(spark, sf_dir, with_description=with_description, with_doc_id=skills or None, with_key_skills=skills)
    p = clean_salaries(p, out="salary_raw_kzt")
    p = normalize_locations(p)
    p = encode_experience(p)
    if skills:
        p = extract_skills(p, tags=document_tags(spark, sf_dir))
    if winsorise:
        p = p.withColumn("salary_monthly_kzt", S.cap("salary_raw_kzt", *salary_fences(spark, sf_dir)))
    else:
        p = p.withColumn("salary_monthly_kzt", F.col("salary_raw_kzt"))
    return p


def posting_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skill_long(processed_postings(spark, sf_dir, winsorise=False))


# ---------------------------------------------------------------- SQL twin --

def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def tag_terms_sql(text_expr: str, vocab=K.TECH_TERMS) -> str:
    """RE2 form of the token-boundary tagging (no look-around in RE2, so the
    neighbours are matched as optional non-word characters)."""
    low = f"lower({text_expr})"
    wc = T.WORD_CLASS
    items = []
    for term in vocab:
        pat = f"(^|[^{wc}]){T.escape_term(term.lower())}($|[^{wc}])"
        items.append(f"CASE WHEN contains({low}, {_sql_str(term.lower())}) AND regexp_matches({low}, {_sql_str(pat)}) "
                     f"THEN {_sql_str(term)} END")
    return f"list_filter([{', '.join(items)}], lambda x: x IS NOT NULL)"


def currency_sql(amount: str, cur: str, rules=K.CURRENCY_RULES) -> str:
    code = f"upper(coalesce(CAST({cur} AS VARCHAR), 'NAN'))"
    whens = []
    for subs, rate in rules:
        cond = " OR ".join(f"contains({code}, '{s}')" for s in subs)
        whens.append(f"WHEN {cond} THEN {amount} * {float(rate)!r}")
    return f"CASE {' '.join(whens)} ELSE {amount} END"


def city_sql(col: str, rules=K.CITY_RULES, default=K.CITY_DEFAULT) -> str:
    low = f"lower({col})"
    whens = []
    for label, sp in rules:
        cond = " OR ".join(f"contains({low}, {_sql_str(s)})" for s in sp)
        whens.append(f"WHEN {cond} THEN '{label}'")
    return f"CASE WHEN {col} IS NULL THEN '{default}' {' '.join(whens)} ELSE '{default}' END"


def ordinal_sql(col: str, mapping=K.EXPERIENCE_LEVELS, default: int = 0) -> str:
    whens = " ".join(f"WHEN {col} = {_sql_str(k)} THEN {v}" for k, v in mapping.items())
    return f"coalesce(CASE {whens} END, {default})"


def slug_sql(x: str) -> str:
    return f"lower(replace(replace({x}, ' ', '_'), '.', ''))"


PROCESSED_SQL = f"""
doc_tags AS (
  SELECT doc_id, {tag_terms_sql('text')} AS skills_extracted FROM documents
),
processed0 AS (
  SELECT p.* EXCLUDE (description),
    {currency_sql("CASE WHEN p.salary_from IS NOT NULL AND p.salary_to IS NOT NULL THEN (p.salary_from + p.salary_to) / 2 ELSE coalesce(p.salary_from, p.salary_to) END", 'p.salary_currency')} AS salary_raw_kzt,
    {city_sql('p.area')} AS area_normalized,
    {ordinal_sql('p.experience')} AS experience_level,
    coalesce(t.skills_extracted, []::VARCHAR[]) AS skills_extracted,
    CASE WHEN p.key_skills IS NULL THEN []::VARCHAR[]
         WHEN contains(p.key_skills, '[') THEN regexp_extract_all(p.key_skills, '''([^'']*)''', 1)
         ELSE list_filter(list_transform(string_split(p.key_skills, ','), lambda x: trim(x)), lambda x: x <> '') END AS skills_key_parsed
  FROM postings p LEFT JOIN doc_tags t ON t.doc_id = p.doc_id
),
salary_bounds AS (
  SELECT q1, q3, q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound FROM (
    SELECT quantile_cont(salary_raw_kzt, 0.25) AS q1, quantile_cont(salary_raw_kzt, 0.75) AS q3 FROM processed0)
),
processed AS (
  SELECT p.*,
    CASE WHEN p.salary_raw_kzt IS NULL THEN NULL ELSE least(greatest(p.salary_raw_kzt, b.lower_bound), b.upper_bound) END AS salary_monthly_kzt,
    list_sort(list_distinct(list_concat(p.skills_extracted, p.skills_key_parsed))) AS skills_all,
    list_sort(list_distinct(list_transform(list_concat(p.skills_extracted, p.skills_key_parsed), lambda x: {slug_sql('x')}))) AS skill_slugs
  FROM processed0 p CROSS JOIN salary_bounds b
),
posting_skill AS (
  SELECT DISTINCT vacancy_id, s AS skill FROM (SELECT vacancy_id, unnest(skill_slugs) AS s FROM processed)
)"""
