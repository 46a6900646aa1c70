"""Connected components of an edge table, by alternating star contractions."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _mark(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def _downward(e: DataFrame) -> DataFrame:
    """Each edge once, from its larger end ``a`` to its smaller end ``b``."""
    return e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of the edges ``a``, ``b``: root is
    the smallest node that links reach.

    Large stars link each node's larger neighbours to its smallest one,
    small stars do so with the smaller neighbours; both keep components
    whole.  They are repeated until every node hangs on its root, a number
    of rounds logarithmic in the longest path.  A node's minimum is
    pre-aggregated, a hub's edges are rows of a join that can be split, and
    each round is a written table.  Loops and repeated edges don't matter.
    """
    e = written(_downward(edges), "edges")
    mark = _mark(e)
    while mark[0]:
        both = e.union(e.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = _downward(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("s")).select("s.*")
        e = written(_downward(small), "edges")
        before, mark = mark, _mark(e)
        if mark == before:
            break
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
