"""File sources and sinks for postings."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NAME = T.StructType([T.StructField("name", T.StringType())])

# Nested posting as the collector receives it.
POSTING_JSON_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("area", NAME),
    T.StructField("salary", T.StructType([T.StructField("from", T.DoubleType()), T.StructField("to", T.DoubleType()),
                                          T.StructField("currency", T.StringType())])),
    T.StructField("experience", NAME),
    T.StructField("schedule", NAME),
    T.StructField("employment", NAME),
    T.StructField("description", T.StringType()),
    T.StructField("key_skills", T.ArrayType(NAME)),
    T.StructField("employer", NAME),
    T.StructField("published_at", T.StringType()),
    T.StructField("alternate_url", T.StringType()),
])

# Flat posting (14 columns) as written to CSV.
POSTING_CSV_SCHEMA = T.StructType([
    T.StructField("vacancy_id", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("area", T.StringType()), T.StructField("salary_from", T.DoubleType()),
    T.StructField("salary_to", T.DoubleType()), T.StructField("salary_currency", T.StringType()),
    T.StructField("experience", T.StringType()), T.StructField("schedule", T.StringType()),
    T.StructField("employment", T.StringType()), T.StructField("description", T.StringType()),
    T.StructField("key_skills", T.StringType()), T.StructField("employer_name", T.StringType()),
    T.StructField("published_at", T.StringType()), T.StructField("url", T.StringType()),
])


def read_postings_csv(spark: SparkSession, path: str, schema: T.StructType = POSTING_CSV_SCHEMA) -> DataFrame:
    """Header, quoted multi-line text, explicit schema (no inference)."""
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"')


def read_postings_json(spark: SparkSession, path: str, schema: T.StructType = POSTING_JSON_SCHEMA,
                       multiline: bool = False) -> DataFrame:
    """Nested posting JSON (JSON lines, or one array per file)."""
    return spark.read.schema(schema).json(path, multiLine=multiline)


def flatten_postings(df: DataFrame) -> DataFrame:
    """S3: nested -> 14 flat columns; a null struct gives null fields; key
    skill names joined with ', '."""
    return df.select(
        F.col("id").alias("vacancy_id"), "name", F.col("area.name").alias("area"),
        F.col("salary.from").alias("salary_from"), F.col("salary.to").alias("salary_to"),
        F.col("salary.currency").alias("salary_currency"), F.col("experience.name").alias("experience"),
        F.col("schedule.name").alias("schedule"), F.col("employment.name").alias("employment"), "description",
        F.array_join(F.coalesce(F.col("key_skills.name"), F.array().cast("array<string>")), ", ").alias("key_skills"),
        F.col("employer.name").alias("employer_name"), "published_at", F.col("alternate_url").alias("url"))


def nest_postings(flat: DataFrame) -> DataFrame:
    """Inverse of S3 for flat postings: the nested JSON shape."""
    def name(c):
        return F.when(F.col(c).isNull(), F.lit(None)).otherwise(F.struct(F.col(c).alias("name")))
    sal = F.when(F.col("salary_from").isNull() & F.col("salary_to").isNull() & F.col("salary_currency").isNull(),
                 F.lit(None)).otherwise(F.struct(F.col("salary_from").alias("from"), F.col("salary_to").alias("to"),
                                                 F.col("salary_currency").alias("currency")))
    skills = F.transform(F.filter(F.split(F.coalesce("key_skills", F.lit("")), ", "), lambda x: x != ""),
                         lambda x: F.struct(x.alias("name")))
    return flat.select(F.col("vacancy_id").cast("string").alias("id"), "name", name("area").alias("area"), sal.alias("salary"),
                       name("experience").alias("experience"), name("schedule").alias("schedule"),
                       name("employment").alias("employment"), "description", skills.alias("key_skills"),
                       name("employer_name").alias("employer"), F.col("published_at").cast("string").alias("published_at"),
                       F.col("url").alias("alternate_url"))


def _stringify(df: DataFrame) -> DataFrame:
    """CSV cannot hold arrays/structs: write them as JSON text."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            cols.append(F.to_json(F.col(f"`{f.name}`")).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "gzip") -> None:
    """Header, no index; nested values as JSON text.  Texts make the
    files many times the size of the tables, so they are compressed; readers
    know it by the file name."""
    _stringify(df).write.mode(mode).option("header", True).option("escape", '"').csv(path, compression=compression)


def write_json(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "gzip") -> None:
    """JSON lines, compressed like the CSV."""
    df.write.mode(mode).json(path, compression=compression)


def write_stage(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Inter-stage table as Parquet (keeps arrays and types)."""
    df.write.mode(mode).parquet(path)


def dedupe_postings(df: DataFrame, key: str = "id", latest: str | None = None) -> DataFrame:
    """One row per key.  With ``latest``, deterministically keep the row
    with the greatest value of that column (ties: the greatest remaining
    columns), as a ``max_by`` aggregate: it combines map-side, so an id
    repeated across a third of all rows never lands whole in one task.
    Without ``latest``: ``dropDuplicates`` (also partial before the shuffle)."""
    if latest is None:
        return df.dropDuplicates([key])
    others = [c for c in df.columns if c not in (key, latest)]
    order = F.struct(F.col(latest), *[F.col(c) for c in others])
    row = F.struct(*[F.col(c) for c in df.columns if c != key])
    g = df.groupBy(key).agg(F.max_by(row, order).alias("_row"))
    return g.select(key, *[F.col(f"_row.{c}").alias(c) for c in df.columns if c != key]).select(*df.columns)
