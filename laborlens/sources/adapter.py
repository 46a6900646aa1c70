"""Posting-shaped view of the star-schema test tables.

One posting per order: ``orders ⋈ customer ⋈ nation ⋈ region`` gives place,
salary range, currency, experience and schedule; the order's distinct part
names are its key skills; a document is its description.  Nulls are derived
deterministically so every cleaning rule is exercised.  The identical SQL is
``POSTINGS_SQL`` below, the first CTE of every oracle query.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# Region -> area spelling, so the city rules see Cyrillic and Latin forms.
REGION_AREA = {"AFRICA": "Алматы", "AMERICA": "Astana", "ASIA": "г. Шымкент", "EUROPE": "Karaganda"}
SEGMENT_CURRENCY = {"AUTOMOBILE": "USD", "BUILDING": "eur", "FURNITURE": "RUR", "HOUSEHOLD": "KZT"}
PRIORITY_EXPERIENCE = {"1-URGENT": "Нет опыта", "2-HIGH": "От 1 года до 3 лет",
                       "3-MEDIUM": "От 3 до 6 лет", "5-LOW": "Более 6 лет"}
STATUS_SCHEDULE = {"F": "Удаленная работа", "O": "Полный день"}


def _case(col, mapping, default=None):
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(default if default is not None else F.lit(None).cast("string"))


def order_part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order key, sorted distinct part names).  Groups are one order's lines,
    so each collected set is bounded by the lines of one order."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return (li.join(part, li.l_partkey == part.p_partkey)
            .groupBy("l_orderkey").agg(F.sort_array(F.collect_set("p_name")).alias("part_names")))


def postings(spark: SparkSession, sf_dir: str, with_description: bool = True,
             with_doc_id: bool | None = None, with_key_skills: bool = True) -> DataFrame:
    """Flat postings: vacancy_id, name, area, salary_from, salary_to,
    salary_currency, experience, schedule, employment, description,
    key_skills, employer_name, published_at, url and, if asked for (as with
    the description), doc_id, which takes a count of the documents.
    ``with_key_skills=False`` leaves that column, and the scan of the order
    lines behind it, out."""
    with_doc_id = with_description if with_doc_id is None else with_doc_id
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation (25) and region (5) are fixed-size dimension tables: broadcast is bounded.
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
    cust = c.join(F.broadcast(geo), c.c_nationkey == geo.n_nationkey).select(
        "c_custkey", "c_name", "c_mktsegment", "r_name")
    base = o.join(cust, o.o_custkey == cust.c_custkey)
    if with_key_skills:
        names = order_part_names(spark, sf_dir)
        base = base.join(names, base.o_orderkey == names.l_orderkey, "left")

    if with_doc_id:
        docs = read_table(spark, sf_dir, "documents")
        n_docs = docs.agg(F.count(F.lit(1)).alias("n_docs"))
        base = base.crossJoin(F.broadcast(n_docs)).withColumn("doc_id", F.pmod(F.col("o_orderkey"), F.col("n_docs")))

    k = F.col("o_orderkey")
    quoted = F.concat(F.lit("["), F.array_join(F.transform("part_names", lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "), F.lit("]"))
    key_skills = (F.when(F.col("part_names").isNull(), F.lit(None).cast("string"))
                  .when(F.pmod(k, F.lit(2)) == 1, quoted).otherwise(F.array_join("part_names", ", ")))
    out = base.select(
        k.alias("vacancy_id"),
        F.concat_ws(" ", F.col("c_mktsegment"), F.lit("position"), F.col("o_orderpriority"),
                    F.lit("for"), F.col("c_name")).alias("name"),
        _case(F.col("r_name"), REGION_AREA, F.col("r_name")).alias("area"),
        F.when(F.pmod(k, F.lit(2)) == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice") * 0.9).alias("salary_from"),
        F.when(F.pmod(k, F.lit(3)) == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice") * 1.1).alias("salary_to"),
        _case(F.col("c_mktsegment"), SEGMENT_CURRENCY).alias("salary_currency"),
        _case(F.col("o_orderpriority"), PRIORITY_EXPERIENCE, F.col("o_orderpriority")).alias("experience"),
        _case(F.col("o_orderstatus"), STATUS_SCHEDULE).alias("schedule"),
        F.col("c_mktsegment").alias("employment"),
        *[key_skills.alias("key_skills")] * with_key_skills,
        F.col("c_name").alias("employer_name"),
        F.col("o_orderdate").alias("published_at"),
        F.concat(F.lit("vacancy/"), k.cast("string")).alias("url"),
        *[F.col("doc_id")] * with_doc_id,
    )
    if with_description:
        # merged, not broadcast: rows of one text come one after another, and
        # files of them compress, while only rows without text are shuffled
        out = out.join(docs.select("doc_id", F.col("text").alias("description")).hint("merge"), "doc_id", "left")
    return out


def _sql_case(col, mapping, default="NULL"):
    parts = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {parts} ELSE {default} END"


POSTINGS_SQL = f"""
part_names AS (
  SELECT l_orderkey, list_sort(list_distinct(list(p_name))) AS part_names
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey
),
postings AS (
  SELECT o.o_orderkey AS vacancy_id,
    concat_ws(' ', c.c_mktsegment, 'position', o.o_orderpriority, 'for', c.c_name) AS name,
    {_sql_case('r.r_name', REGION_AREA, 'r.r_name')} AS area,
    CASE WHEN o.o_orderkey % 2 = 0 THEN NULL ELSE o.o_totalprice * 0.9 END AS salary_from,
    CASE WHEN o.o_orderkey % 3 = 0 THEN NULL ELSE o.o_totalprice * 1.1 END AS salary_to,
    {_sql_case('c.c_mktsegment', SEGMENT_CURRENCY)} AS salary_currency,
    {_sql_case('o.o_orderpriority', PRIORITY_EXPERIENCE, 'o.o_orderpriority')} AS experience,
    {_sql_case('o.o_orderstatus', STATUS_SCHEDULE)} AS schedule,
    c.c_mktsegment AS employment,
    CASE WHEN pn.part_names IS NULL THEN NULL
         WHEN o.o_orderkey % 2 = 1 THEN '[' || array_to_string(list_transform(pn.part_names, lambda x: '''' || x || ''''), ', ') || ']'
         ELSE array_to_string(pn.part_names, ', ') END AS key_skills,
    c.c_name AS employer_name,
    o.o_orderdate AS published_at,
    'vacancy/' || CAST(o.o_orderkey AS VARCHAR) AS url,
    o.o_orderkey % nd.n_docs AS doc_id,
    d.text AS description
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN part_names pn ON pn.l_orderkey = o.o_orderkey
  CROSS JOIN (SELECT count(*) AS n_docs FROM documents) nd
  LEFT JOIN documents d ON d.doc_id = o.o_orderkey % nd.n_docs
)"""
