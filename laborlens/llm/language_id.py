"""Language identification with bit-sliced Bloom filters of n-grams.

One table of slots stands for a Bloom filter per language: bit ``l`` of a
slot belongs to language ``l``, so a look-up of an n-gram's few slots and an
AND of them returns all languages that contain the n-gram at once.  Per
text, the counts of each bit over its n-grams, corrected for the share that
a filter as full as that language's claims falsely, decide.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, importable, lean, whole_text, written

UNDETERMINED = "und"
STRIP = 1 << 20  # characters; a longer text is counted strip by strip
ORDERS = (3, 4)


@dataclass
class Model:
    """``langs`` (most frequent first), ``slots`` (one or more 64-bit words
    of language bits per slot), ``false_rate`` per language, ``hashes``."""

    langs: list[str]
    slots: np.ndarray
    false_rate: np.ndarray
    hashes: int


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of lower-cased words with a space at either
    end, and the text each comes from, texts in order."""
    lowered = [" " + t.lower() + " " for t in texts]
    code = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in lowered])
    letter = _letters()[code]
    keep = letter.copy()
    keep[1:] |= letter[:-1] & ~letter[1:]           # the space after a word
    keep[:-1] |= letter[1:] & ~letter[:-1]          # the space before one
    code, owner = np.where(letter, code, 32)[keep].astype(np.uint64), owner[keep]
    again = np.zeros(len(code), bool)
    if len(code):                                   # two spaces in a row: one is enough
        again[1:] = (code[1:] == 32) & (code[:-1] == 32) & (owner[1:] == owner[:-1])
    code, owner = code[~again], owner[~again]
    out, whose = [], []
    for n in ORDERS:
        m = len(code) - n + 1
        if m <= 0:
            continue
        h = _hashes(code, n, m)
        inside = owner[:m] == owner[n - 1:n - 1 + m]
        out.append(h[inside])
        whose.append(owner[:m][inside])
    if not out:
        return np.empty(0, np.uint64), np.empty(0, np.int32)
    order = np.argsort(np.concatenate(whose), kind="stable")
    return np.concatenate(out)[order], np.concatenate(whose)[order]


def strip_grams(text: str, size: int = 1 << 20) -> Iterator[np.ndarray]:
    """:func:`grams` of one long text, strip by strip: besides the text and
    its lower case only a strip's arrays are held.  A strip starts from the
    characters that the last one kept, so no n-gram is lost or counted twice."""
    low = " " + text.lower() + " "
    held, most = np.empty(0, np.uint64), max(ORDERS) - 1
    for at in range(0, len(low), size):
        lo, hi = max(at - 1, 0), min(at + size + 1, len(low))
        code = np.frombuffer(low[lo:hi].encode("utf-32-le", "surrogatepass"), "<u4")
        letter = _letters()[code]
        keep = letter.copy()
        keep[1:] |= letter[:-1] & ~letter[1:]
        keep[:-1] |= letter[1:] & ~letter[:-1]
        own = slice(at - lo, at - lo + size)
        code = np.where(letter, code, 32)[own][keep[own]].astype(np.uint64)
        code = np.concatenate([held, code])
        again = np.zeros(len(code), bool)
        again[1:] = (code[1:] == 32) & (code[:-1] == 32)
        code = code[~again]
        out = []
        for n in ORDERS:
            new = code[max(0, len(held) - n + 1):]       # windows that end behind what was held
            m = len(new) - n + 1
            if m > 0:
                out.append(_hashes(new, n, m))
        if out:
            yield np.concatenate(out)
        held = code[-most:]


def _hashes(code: np.ndarray, n: int, m: int) -> np.ndarray:
    h = np.full(m, n, np.uint64)
    for k in range(n):
        h = (h ^ code[k:k + m]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def _slot(h: np.ndarray, k: int, size: int) -> np.ndarray:
    x = (h ^ np.uint64(0xD6E8FEB86659FD93 * (k + 1) & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return ((x ^ (x >> np.uint64(32))) & np.uint64(size - 1)).astype(np.int64)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", order_col: str = "doc_id",
          per_language: int = 1000, min_share: float = 2e-5, near_best: float = 0.3,
          slots: int = 1 << 20, hashes: int = 2) -> Model:
    """Fit the filters on about ``per_language`` texts of each language,
    chosen by a hash of ``order_col`` and the text, so that null or repeated
    ids are drawn one by one (a documented bound of the sample; all texts of
    a language that has fewer).

    An n-gram belongs to a language if it makes up at least ``min_share`` of
    its n-grams and at least ``near_best`` of its share in the language where
    it is most frequent.  By the first rule a language has at most
    2 / min_share n-grams, which bounds what reaches the driver.
    """
    spark = labelled.sparkSession
    importable(spark)
    src = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
        F.pmod(F.xxhash64(order_col, text_col), F.lit(1_000_000)).alias("draw"))
    count = {r["lang"]: r["n"] for r in src.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(count, key=lambda x: (-count[x], x))
    words = max(1, -(-len(langs) // 64))
    table = np.zeros((slots, words), np.uint64)
    if not langs:
        return Model([], table, np.zeros(0), hashes)
    cut = F.create_map(*[F.lit(x) for name in langs for x in (name, min(1.0, per_language / count[name]) * 1_000_000)])

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "text", 1 << 22):
                names, texts = np.array(part.column("lang").to_pylist(), object), part.column("text").to_pylist()
                if len(texts) == 1 and len(texts[0]) > STRIP:
                    found = ((names[0], h) for h in strip_grams(texts[0]))
                else:
                    h, whose = grams(texts)
                    found = ((name, h[(names == name)[whose]] if len(h) else h) for name in dict.fromkeys(names))
                for name, own in found:
                    g, n = np.unique(own, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(g), pa.string()), pa.array(g.view(np.int64)), pa.array(n.astype(np.int64))],
                        names=["lang", "gram", "n"])

    counted = written(src.where(F.col("draw") < F.element_at(cut, F.col("lang"))).select("lang", "text")
                      .mapInArrow(lean(tally), "lang string, gram bigint, n bigint")
                      .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    total = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    share = counted.join(F.broadcast(total), "lang").select("lang", "gram", (F.col("n") / F.col("total")).alias("share"))
    best = share.where(F.col("share") >= min_share).groupBy("gram").agg(
        F.max("share").alias("best"), F.map_from_entries(F.collect_list(F.struct("lang", "share"))).alias("shares"))
    kept = best.select("gram", F.map_keys(F.map_filter("shares", lambda _, s: s >= F.col("best") * near_best)).alias("langs"))
    got = kept.toArrow()
    at = {name: i for i, name in enumerate(langs)}
    own = got.column("langs").combine_chunks()
    g = got.column("gram").to_numpy().view(np.uint64)
    flat = np.array([at[x] for x in own.flatten().to_pylist()], np.int64)
    rows = np.repeat(np.arange(len(g)), np.diff(own.offsets.to_numpy()))
    for k in range(hashes):
        np.bitwise_or.at(table, (_slot(g, k, slots)[rows], flat // 64), np.uint64(1) << (flat % 64).astype(np.uint64))
    full = np.array([((table[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(langs))])
    return Model(langs, table, full ** hashes, hashes)


def _claims(model: Model, h: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Per language how many of each run of n-grams its filter claims."""
    hit = model.slots[_slot(h, 0, len(model.slots))]
    for k in range(1, model.hashes):
        hit = hit & model.slots[_slot(h, k, len(model.slots))]
    counts = np.empty((len(model.langs), len(ends) - 1))
    for i in range(len(model.langs)):
        bits = ((hit[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).astype(np.uint8)
        run = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])
        counts[i] = run[ends[1:]] - run[ends[:-1]]
    return counts


def evidence(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Per text its number of n-grams, and per language and text how many
    the language's filter claims.  A long text is added up over strips."""
    n, counts = np.zeros(len(texts), np.int64), np.zeros((len(model.langs), len(texts)))
    long = [j for j, t in enumerate(texts) if len(t) > STRIP]
    for j in long:
        for h in strip_grams(texts[j]):
            n[j] += len(h)
            counts[:, j] += _claims(model, h, np.array([0, len(h)]))[:, 0]
    short = [j for j, t in enumerate(texts) if len(t) <= STRIP]
    if short:
        h, whose = grams([texts[j] for j in short])
        ends = np.searchsorted(whose, np.arange(len(short) + 1))
        n[short], counts[:, short] = np.diff(ends), _claims(model, h, ends)
    return n, counts


def decide(model: Model, texts: list[str]) -> tuple[list[str], list[float]]:
    """Language and score per text.  The score is the winner's share of all
    languages' corrected counts; ties go to the language with more texts."""
    return decide_from(model, texts, *evidence(model, texts))


def decide_from(model: Model, texts: list[str], n: np.ndarray, counts: np.ndarray) -> tuple[list[str], list[float]]:
    """:func:`decide` from the texts' evidence."""
    pred, score = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    if not model.langs or not texts:
        return pred, score
    fp = model.false_rate[:, None]
    counts = np.maximum(0.0, (counts - n * fp) / np.maximum(1e-12, 1 - fp))
    best, all_ = counts.argmax(0), counts.sum(0)
    for j, text in enumerate(texts):
        if n[j] or any(map(str.isalpha, text)):
            pred[j] = model.langs[best[j]]
            score[j] = float(counts[best[j], j] / all_[j]) if all_[j] else 0.0
    return pred, score


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
             keep: list[str] | None = None, with_grams: bool = False) -> DataFrame:
    """The columns ``keep`` (default: ``id_col``) with ``lang_pred``,
    ``score`` (0 to 1) and, if asked for, ``n_grams`` (the text's n-grams) per
    row, from the text alone.  Score 0 over many n-grams: no language claims any of them.

    Null texts and texts without a letter are ``und`` with score 0; so is
    everything if no language was learned.  Repeated rows get equal results.
    The model is broadcast; its size is its ``slots`` parameter.  Of a text
    of any length the text, its lower case and a strip's n-grams are held.
    """
    spark = docs.sparkSession
    importable(spark)
    keep = keep or [id_col]
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in by_bytes(batch, "_text", 1 << 20):
                texts = part.column("_text").to_pylist()
                n, counts = evidence(m, texts)
                pred, score = decide_from(m, texts, n, counts)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(n, pa.int64())],
                    names=[*part.schema.names[:-1], "lang_pred", "score", "n_grams"])

    src = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)], whole_text(text_col).alias("_text"))
    kinds = [f"c{i} {src.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(keep))]
    out = src.mapInArrow(lean(run), ", ".join([*kinds, "lang_pred string", "score double", "n_grams bigint"]))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], "lang_pred", "score", *["n_grams"] * with_grams)
