"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most 2r bits have a common variant within
r bits of each.  Every distinct fingerprint emits all its variants within r;
a shuffle on the variants brings together those that share one.  Such a
group lies in one ball of radius r, so it holds at most as many distinct
fingerprints as the ball, however many documents there are, and its members
are within 2r bits of each other.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_bytes, importable, lean, whole_text, written
from .components import components

STRIP = 1 << 16  # shingles whose bits are counted at once
PIECE = 1 << 20  # bytes of a text that are split into words at once
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _word_pieces(text: bytes | memoryview) -> Iterator[list[bytes]]:
    """The lower-cased words of a text, piece by piece; pieces end at white
    space, so a long text's words are never held together."""
    at = 0
    while True:
        end = at + PIECE
        if end < len(text):
            m = SPACE.search(text, end)
            end = m.start() if m else len(text)
        yield bytes(text[at:end]).lower().split()
        if end >= len(text):
            return
        at = end


def fingerprint(text: bytes | memoryview, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash: A-Z lower-cased, words between ASCII white
    space, every run of ``shingle`` words (repeats included, fewer words: all
    of them) hashed; a bit is set if over half of the hashes have it.  No
    words: zero."""
    from xxhash import xxh64_intdigest

    ones, n, held = np.zeros(64, np.int64), 0, []
    for new in _word_pieces(text):
        words = held + new
        hashes = map(xxh64_intdigest, map(b" ".join, zip(*(words[i:] for i in range(shingle)))), repeat(seed))
        while (h := np.fromiter(islice(hashes, STRIP), np.uint64)).size:
            n += h.size
            ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
        held = words[-(shingle - 1):] if shingle > 1 else []
        few = words
    if n:
        return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])
    return xxh64_intdigest(b" ".join(few), seed) if few else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``id``, ``fp`` (the fingerprint's bits as a bigint) per row."""
    importable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "text", 1 << 22):
                fp = [fingerprint(memoryview(t.as_buffer()), shingle) for t in part.column("text")]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(np.array(fp, np.uint64).view(np.int64))],
                                                 names=["id", "fp"])

    src = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    return src.mapInArrow(lean(run), f"id {src.schema['id'].dataType.simpleString()}, fp bigint")


def ball_links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Edges ``a``, ``b`` between distinct fingerprints ``fp`` of at most
    ``max_bits`` (even) differing bits: from each that shares a variant with
    a smaller one to the smallest.  They connect what all such links
    connect, as those that share a variant are all linked to that one."""
    if max_bits % 2:
        raise ValueError("max_bits must be even: half of it is the radius of the balls")
    flips = [sum(1 << b for b in bits) for r in range(max_bits // 2 + 1) for bits in combinations(range(64), r)]
    masks = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m).cast("bigint") for m in flips])
    balls = fps.select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("variant"))
    met = balls.select(F.col("fp").alias("a"), F.min("fp").over(Window.partitionBy("variant")).alias("b"))
    return met.where("a <> b").distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """Per row: ``id_col``, ``fingerprint`` (16 lower-case hex digits),
    ``component_id`` (the smallest id reachable over links).

    A null or empty text has no words: fingerprint zero, linked like any
    other.  A long text is read piece by piece.  Rows with a null id get a
    fingerprint and their component like any other; a null id is never the
    smallest while another is there.  Equal fingerprints, copies above all, are one node; so a group
    of copies costs one row beyond the fingerprinting.  Repeated rows get
    the same component; other columns are ignored.
    """
    each = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = written(each.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    hung = components(ball_links(nodes.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    rooted = nodes.join(hung, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    first = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(rooted.join(first, "root").select("fp", "component_id"), "named")
    return each.join(named, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
