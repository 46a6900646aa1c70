"""C6 for dictionaries of any size: tagging by a join with a term table.

:func:`..functions.text.tag_terms` has an expression per term, which serves
some hundred of them.  Here a text and the terms are cut into the same tokens
(maximal runs of word characters, and every other character on its own), and
the texts' token runs meet the terms in one hash join.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WORD_CLASS

LENGTHS = 64          # different numbers of tokens that terms may have
FIRSTS = 10_000       # first tokens that are looked up in a row; more are left to the join


def tokens(text: Column) -> Column:
    """Lower-cased maximal word runs and single other characters, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"[{WORD_CLASS}]+|[^{WORD_CLASS}]"), 0)


def term_table(terms: DataFrame, term_col: str = "term") -> DataFrame:
    """``term``, ``gram`` (its tokens joined, i.e. the lower-cased term) and
    ``n`` (their number); null and empty terms are left out."""
    t = F.col(term_col).cast("string")
    d = terms.where(t.isNotNull() & (t != "")).select(t.alias("term")).distinct()
    return d.select("term", F.lower("term").alias("gram"), F.size(tokens(F.col("term"))).alias("n"))


def text_grams(rows: DataFrame, text_col: str, lengths: list[int], firsts: list[str] | None = None) -> DataFrame:
    """``_row`` and each distinct run of as many tokens as some term has, so
    far as the characters around it let it be a term: one that begins or ends
    with another character must have no word next to it there.  ``firsts``:
    the terms' first tokens, where they are few; no other run is made."""
    word = f"^[{WORD_CLASS}]"

    def runs(n: int) -> Column:
        def ok(i: Column) -> Column:
            first, last = F.get("_t", i), F.get("_t", i + (n - 1))
            open_ = first.rlike(word) | ~F.coalesce(F.get("_t", i - 1).rlike(word), F.lit(False))
            shut = last.rlike(word) | ~F.coalesce(F.get("_t", i + n).rlike(word), F.lit(False))
            return (first.isin(firsts) & open_ & shut) if firsts is not None else open_ & shut
        starts = F.when(F.size("_t") >= n, F.sequence(F.lit(0), F.size("_t") - n)).otherwise(F.array().cast("array<int>"))
        return F.array_distinct(F.transform(F.filter(starts, ok), lambda i: F.array_join(F.slice("_t", i + 1, n), "")))

    d = rows.where(F.col(text_col).isNotNull()).select("_row", tokens(F.col(text_col).cast("string")).alias("_t"))
    return d.select("_row", F.explode(F.flatten(F.array(*[runs(n) for n in lengths]))).alias("gram")) if lengths else \
        d.select("_row", F.lit("").alias("gram")).where("false")


def tag_by_table(docs: DataFrame, terms: DataFrame, text_col: str = "text", term_col: str = "term",
                 out: str = "skills_extracted", broadcast_rows: int = 100_000) -> DataFrame:
    """``docs`` with ``out``, the sorted terms that occur in the text with no
    word character right before or after (``tag_terms`` with its token
    boundary, any number of terms).

    Runs are distinct per text before they are joined.  The term table is
    broadcast if it is counted to have at most ``broadcast_rows`` rows, of at
    most some tokens each; otherwise both sides are shuffled by run.  A null
    text has no terms; rows are rows of their own, whatever their ids."""
    table = term_table(terms, term_col)
    lengths = sorted(r[0] for r in table.select("n").distinct().limit(LENGTHS + 1).collect())
    if len(lengths) > LENGTHS:
        raise ValueError(f"terms have more than {LENGTHS} different numbers of tokens")
    rows = docs.withColumn("_row", F.monotonically_increasing_id())
    small = table.limit(broadcast_rows + 1).count() <= broadcast_rows
    look = table.select("gram", "term")
    begin = table.select(F.get(tokens(F.col("term")), F.lit(0))).distinct().limit(FIRSTS + 1).collect() if small else []
    firsts = [r[0] for r in begin] if small and len(begin) <= FIRSTS else None
    hits = text_grams(rows, text_col, lengths, firsts).join(F.broadcast(look) if small else look, "gram")
    found = hits.groupBy("_row").agg(F.sort_array(F.collect_set("term")).alias(out))
    none = F.array().cast("array<string>")
    return rows.join(found, "_row", "left").withColumn(out, F.coalesce(out, none)).drop("_row")
