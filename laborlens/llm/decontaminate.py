"""Benchmark decontamination with a positional inverted index, in DataFrame
functions only.

Of each test window (a run of item words) only the rarest term of the corpus
is looked up.  The index stores the postings of those terms: document,
position and the words on either side.  A posting minus the term's offset in
the window is a candidate start; the other terms' offset-adjusted positions
are read from the stored neighbours, so the intersection needs no second
shuffle of postings.  Exact phrases and proximity matches come from it.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import whole_text, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
END = ""  # the posting that marks a document's end; no word is empty


def words(text: str | Column) -> Column:
    """A-Z lower-cased, cut at every ASCII character but digits and letters.
    ``lower`` also changes letters beyond ASCII, so it serves only texts
    that have none (as many bytes as characters)."""
    t = whole_text(text)
    plain = F.octet_length(t) == F.length(t)
    low = F.when(plain, F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))
    return F.array_remove(F.split(low, BREAK), "")


def small(df: DataFrame, text_cols: list[str], most: int) -> bool:
    """Whether the table is proven to be below ``most`` bytes: its strings'
    bytes and 64 for each row."""
    each = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in text_cols), F.lit(64))
    return (df.agg(F.sum(each.cast("bigint"))).first()[0] or 0) <= most


def test_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = 10) -> DataFrame:
    """``item_id`` (as a string), ``phrase``: each run of ``size`` words of an
    item; an item of fewer words is one window, one of none has no window."""
    row = items.select(F.col(id_col).cast("string").alias("item_id"), words(text_col).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    runs = F.transform(starts, lambda s: F.array_join(F.slice(F.col("words"), s, F.lit(size)), " "))
    return row.select("item_id", F.explode(runs).alias("phrase")).distinct()


def _tokens(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    row = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                      F.concat(words(text_col), F.array(F.lit(END))).alias("words"))
    return row.select("row", "id", "words", F.posexplode("words").alias("pos", "term"))


def anchors(docs: DataFrame, phrases: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            broadcast_bytes: int = 32 << 20) -> DataFrame:
    """``phrase``, ``term``, ``offset`` per phrase all of whose terms are in
    the corpus: its rarest term there and where that stands in the phrase."""
    parts = phrases.select("phrase", F.posexplode(F.split("phrase", " ")).alias("offset", "term"))
    terms = written(parts.select("term").distinct(), "terms")
    if small(terms, ["term"], broadcast_bytes):
        terms = F.broadcast(terms)
    counts = _tokens(docs, id_col, text_col).select("term").join(terms, "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    rarest = parts.join(counts, "term", "left").groupBy("phrase").agg(
        F.min(F.struct("n", "term", "offset")).alias("rare"), F.count("n").alias("known"), F.count(F.lit(1)).alias("terms"))
    return written(rarest.where("known = terms").select("phrase", "rare.term", "rare.offset"), "anchors")


def build_index(docs: DataFrame, anchor: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                reach: int = 9, broadcast_bytes: int = 32 << 20) -> DataFrame:
    """Postings of the anchors' terms: ``row`` (a number per row of docs, as
    ids may repeat), ``id``, ``term``, ``pos``, ``first`` (position of the
    first neighbour), ``around`` (the words within ``reach``); and one of
    the empty term per row, at the position after its last word."""
    spark = docs.sparkSession
    terms = anchor.select("term").distinct().union(spark.range(1).select(F.lit(END).alias("term")))
    first = F.greatest(F.col("pos") - reach, F.lit(0))
    around = F.when(F.col("term") != END, F.slice("words", first + 1, F.col("pos") - first + 1 + reach))
    tokens, cut = _tokens(docs, id_col, text_col), ["row", "id", "term", "pos", first.alias("first"), around.alias("around")]
    if small(anchor, ["term"], broadcast_bytes):  # no shuffle: only the words that join are cut
        posts = tokens.join(F.broadcast(terms), "term").select(*cut)
    else:  # a shuffled row must not hold the whole document
        posts = tokens.select(*cut).join(terms, "term")
    return written(posts.select("row", "id", "term", "pos", "first", "around"), "postings")


def phrase_matches(index: DataFrame, anchor: DataFrame, slop: int = 0, broadcast_bytes: int = 32 << 20) -> DataFrame:
    """``row``, ``id``, ``phrase``, ``start``, ``len``, ``exact`` per place
    where a phrase stands word for word, and, with ``slop``, where all its
    terms stand near its rarest one: at most ``slop`` words further off than
    in the phrase.  The index must reach as far (phrase length - 1 + slop)."""
    a = anchor.withColumn("terms", F.split("phrase", " "))
    if small(anchor, ["phrase", "phrase", "term"], broadcast_bytes):
        a = F.broadcast(a)
    start, size = F.col("pos") - F.col("offset"), F.size("terms")
    at = start - F.col("first")
    got = F.slice("around", F.greatest(at, F.lit(0)) + 1, size)
    exact = (at >= 0) & (got == F.col("terms"))
    near = F.lit(False)
    if slop:
        low = F.greatest(at - slop, F.lit(0))
        near = F.size(F.array_except("terms", F.slice("around", low + 1, at + size + slop - low))) == 0
    return index.where(F.col("term") != END).join(a, "term").where(exact | near).select(
        "row", "id", "phrase", start.alias("start"), size.alias("len"), exact.alias("exact"))


def covered(hits: DataFrame) -> DataFrame:
    """``row``, ``n_hit``: words inside any match, each counted once."""
    runs = hits.groupBy("row", "start").agg(F.max("len").alias("len"))
    before = F.max(F.col("start") + F.col("len")).over(
        Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.col("start") + F.col("len") - F.greatest("start", F.coalesce(before, F.lit(0)))
    return runs.select("row", F.greatest(fresh, F.lit(0)).alias("fresh")).groupBy("row").agg(F.sum("fresh").alias("n_hit"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", size: int = 10,
                  broadcast_bytes: int = 32 << 20) -> DataFrame:
    """Per row of ``docs``: ``id_col``, ``n_words``, ``n_hit``, ``n_items``,
    ``items_sha256`` (of the sorted ids of matched items joined by commas;
    of the empty text if there are none), ``contaminated``.

    Null and empty texts have no words; an empty ``items`` table contaminates
    nothing; repeated rows, also of one id or a null one, are judged each on
    its own.  An item with a null id contaminates like any other, but has no
    id to be listed or counted by.  Other columns of either table are ignored.
    """
    of = written(test_windows(items, item_col, item_text, size), "windows")
    anchor = anchors(docs, of.select("phrase").distinct(), id_col, text_col, broadcast_bytes)
    index = build_index(docs, anchor, id_col, text_col, size - 1, broadcast_bytes)
    hits = written(phrase_matches(index, anchor, 0, broadcast_bytes), "hits")
    found = (hits.select("row", "phrase").distinct().join(of, "phrase").groupBy("row")
             .agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    whole = index.where(F.col("term") == END).select("row", "id", F.col("pos").cast("bigint").alias("n_words"))
    names = F.coalesce("items", F.array().cast("array<string>"))
    return (whole.join(covered(hits).join(found, "row"), "row", "left")
            .select(F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                    F.size(names).cast("bigint").alias("n_items"), F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
                    F.col("n_hit").isNotNull().alias("contaminated")))
