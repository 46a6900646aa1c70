"""Corpus pipeline: each stage works on what the stage before kept.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``documents``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlens.llm import bpe_tree, decontaminate, language_id, simhash, suffix_dedup
from laborlens.llm.common import written
from laborlens.sources.tables import read_table


#: So many n-grams of which no language claims any are no language's text;
#: fewer, as of a name or a heading, are no evidence.
ENOUGH_GRAMS = 50


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language can be told.  A text with no letter, a
    null one among them, is rejected, and so is one of ``ENOUGH_GRAMS`` or
    more n-grams for which no learned language has evidence: none claims more
    of them than its filter claims of anything."""
    model = language_id.learn(docs.where(~language_id.held_out()))
    found = language_id.identify(docs, model, keep=docs.columns, text_col="text", with_grams=True)
    foreign = (F.col("score") == 0) & (F.col("n_grams") >= ENOUGH_GRAMS)
    return found.where((F.col("lang_pred") != language_id.UNDETERMINED) & ~foreign).select(*docs.columns)


def with_row_key(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with ``row_key``, a number per row that is the same whenever
    it is read; ids may be null or repeat."""
    return written(docs.withColumn("row_key", F.monotonically_increasing_id()), name)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group: the one with the smallest id (a null one
    comes last), of several the first by row key.  Rows are documents of
    their own, also where their ids are null or repeat."""
    rows = with_row_key(docs, "simhash-rows")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")
    found = simhash.near_duplicates(rows.withColumn("order", order), id_col="order", shingle=3, max_bits=2)
    first = found.where("order <=> component_id").select("order.row_key")
    return rows.join(first, "row_key", "left_semi").select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove text that also starts earlier; every document stays, shorter."""
    cut = suffix_dedup.remove_repeats(docs, length=100, keep=[c for c in docs.columns if c not in ("doc_id", "text", "n_chars")], with_text=True)
    return cut.select(*[F.col("kept_text").alias(c) if c == "text" else F.length("kept_text").cast("bigint").alias(c) if c == "n_chars"
                        else F.col(c) for c in docs.columns])


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the rows that hold a window of a benchmark item; rows with the
    same id, or none, are judged each on its own."""
    rows = with_row_key(docs, "benchmark-rows")
    judged = decontaminate.contamination(rows, read_table(spark, sf_dir, "benchmark"), id_col="row_key")
    return rows.join(judged.where("contaminated").select("row_key"), "row_key", "left_anti").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every remaining text, with digests of the ids and of
    what they decode to."""
    return bpe_tree.encode_decode(docs, with_ids=True)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", decontaminate_benchmark),
    ("bpe_encoding", encode),
]

#: SQL cannot express the stages; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read back."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
