"""Registered queries (one per inventory id) and their DuckDB oracles.

Every query reads the given tables (or what Spark derives from them) in
full.  Doubles are rounded identically on both sides; counts are bigint.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.adapter import POSTINGS_SQL
from .build import building
from .preprocess import PROCESSED_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            with building():
                return fn(spark, sf_dir)
        query.__name__ = name
        query.__doc__ = fn.__doc__
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def with_ctes(body: str, processed: bool = True) -> str:
    ctes = POSTINGS_SQL + ("," + PROCESSED_SQL if processed else "")
    b = body.lstrip()
    if b[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{b[5:]}"
    return f"WITH {ctes}\n{body}"


def rnd(c, d: int = 2):
    return F.round(F.col(c) if isinstance(c, str) else c, d)


def big(c):
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")
