"""Hard negatives: exact integer scores of anchors against all rows, by tiles.

Anchors are dealt to blocks and all rows to slabs, and each pair of a block
and a slab is multiplied strip by strip: Strassen's recursion on int64 tiles
that are padded with zeros.  What a task keeps is a heap per anchor (its best
positives) or per anchor and positive (the best negatives of that positive's
window); heaps of different tasks are merged by one more ranking.  No pair is
ever a row.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .common import importable, lean, written

LEAF = 32                 # a side of this length or less is not halved further
LAST = np.iinfo(np.int64).max


# ---------------------------------------------------------------- Strassen
def _leaf(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A small product.  Where every partial sum stays below 2^53, doubles
    hold it exactly and the processor's own multiplication serves."""
    if a.size and b.size:
        bound = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
        if bound < 2.0 ** 53:
            return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def _halved(n: int, times: int) -> int:
    """``n`` rounded up to what can be halved so many times."""
    return -(-n >> times) << times


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of int64 matrices, exact modulo 2^64: seven products of
    halves instead of eight, until the shortest side is a leaf."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    times = 0
    while min(m, k, n) >> times > leaf:
        times += 1
    if not times:
        return _leaf(a, b)
    mp, kp, np_ = (_halved(x, times) for x in (m, k, n))
    if (mp, kp) != a.shape:
        a = np.pad(a, ((0, mp - m), (0, kp - k)))
    if (kp, np_) != b.shape:
        b = np.pad(b, ((0, kp - k), (0, np_ - n)))
    return _multiply(a, b, times)[:m, :n]


def _multiply(a: np.ndarray, b: np.ndarray, times: int) -> np.ndarray:
    if not times:
        return _leaf(a, b)
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    out = np.empty((2 * m, 2 * n), np.int64)
    c11, c12, c21, c22 = out[:m, :n], out[:m, n:], out[m:, :n], out[m:, n:]
    p = _multiply(a11 + a22, b11 + b22, times - 1)
    c11[:], c22[:] = p, p
    p = _multiply(a21 + a22, b11, times - 1)
    c21[:] = p
    c22 -= p
    p = _multiply(a11, b12 - b22, times - 1)
    c12[:] = p
    c22 += p
    p = _multiply(a22, b21 - b11, times - 1)
    c11 += p
    c21 += p
    p = _multiply(a11 + a12, b22, times - 1)
    c11 -= p
    c12 += p
    c22 += _multiply(a21 - a11, b11 + b12, times - 1)
    c11 += _multiply(a12 - a22, b21 + b22, times - 1)
    return out


# ------------------------------------------------------------------- heaps
class Heaps:
    """The ``k`` best entries of each of ``n`` slots: larger scores first,
    then smaller ids (a null id last), then smaller rows."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.size = np.zeros(n, np.int64)
        self.entry = {c: np.zeros((n, k), np.int64) for c in ("score", "id", "row")}

    def floor(self) -> np.ndarray:
        """Per slot the least score that can still enter."""
        return np.where(self.size == self.k, self.entry["score"][:, -1], -LAST)

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray, row: np.ndarray) -> None:
        if not len(slot):
            return
        touched = np.unique(slot)
        old, place = np.nonzero(np.arange(self.k) < self.size[touched, None])
        old = touched[old]
        both = [np.concatenate(x) for x in zip(
            (slot, score, ids, row), (old, *(self.entry[c][old, place] for c in ("score", "id", "row"))), strict=True)]
        slot, score, ids, row = (x[np.lexsort((both[3], both[2], -both[1], both[0]))] for x in both)
        first = np.searchsorted(slot, touched)
        rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        keep = rank < self.k
        slot, rank = slot[keep], rank[keep]
        for c, x in (("score", score), ("id", ids), ("row", row)):
            self.entry[c][slot, rank] = x[keep]
        self.size[touched] = np.minimum(np.diff(np.append(first, len(score))), self.k)

    def rows(self) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        slot, place = np.nonzero(np.arange(self.k) < self.size[:, None])
        return slot, {c: x[slot, place] for c, x in self.entry.items()}


# ------------------------------------------------------------------- tiles
def strips(n: int, most: int) -> Iterator[tuple[int, int]]:
    """Growing strips of ``n`` rows: while heaps are still filling, many
    entries pass, so the first strips are short."""
    at, step = 0, 64
    while at < n:
        yield at, min(at + step, n)
        at, step = at + step, min(2 * step, most)


def _columns(batch: pa.RecordBatch | pa.Table) -> dict[str, np.ndarray]:
    t = pa.Table.from_batches([batch]).combine_chunks() if isinstance(batch, pa.RecordBatch) else batch.combine_chunks()
    out = {c: t.column(c).to_numpy() for c in ("grp", "dim", "row", "side", "label")}
    out["null"] = np.asarray(t.column("id").is_null())
    out["id"] = t.column("id").fill_null(LAST).to_numpy()
    out["flat"] = t.column("q").combine_chunks().flatten().to_numpy()
    out["more"] = t.column("goals").combine_chunks()
    return out


class Tile:
    """The anchors of one group; strips of candidates are fed to it."""

    def __init__(self, anchors: dict[str, np.ndarray], k: int):
        self.a = anchors
        self.n = len(anchors["row"])
        self.heaps = Heaps(self.n * self.slots, k)

    slots = 1


class Positives(Tile):
    """Best rows of the anchor's own label: tiles cut by label, so only
    those scores are computed."""

    def feed(self, c: dict[str, np.ndarray]) -> None:
        a = self.a
        for label in np.intersect1d(a["label"], c["label"]):
            i, j = np.flatnonzero(a["label"] == label), np.flatnonzero(c["label"] == label)
            score = strassen(a["x"][i], c["x"][j].T)
            hit = score >= self.heaps.floor()[i, None]
            hit &= a["row"][i, None] != c["row"][j]
            p, q = np.nonzero(hit)
            self.heaps.add(i[p], score[p, q], c["id"][j[q]], c["row"][j[q]])

    def result(self) -> dict[str, np.ndarray]:
        slot, e = self.heaps.rows()
        return {"anchor": self.a["row"][slot], "pos": np.zeros(len(slot), np.int32), **e}


class Negatives(Tile):
    """Best rows of other labels inside each positive's window of scores."""

    def __init__(self, anchors: dict[str, np.ndarray], k: int, slots: int, low: tuple[int, int], high: tuple[int, int]):
        self.slots = slots
        super().__init__(anchors, k)
        goals = anchors["more"]
        sizes = goals.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        flat = goals.flatten().to_numpy(zero_copy_only=False)
        self.lo = np.full((self.n, slots), LAST)
        self.hi = np.full((self.n, slots), -LAST)
        at = 0
        for i, size in enumerate(sizes.tolist()):
            for s, score in enumerate(flat[at:at + size].tolist()):  # Python's integers: no product overflows
                self.lo[i, s] = -(-low[0] * score // low[1])
                self.hi[i, s] = high[0] * score // high[1]
            at += size

    def feed(self, c: dict[str, np.ndarray]) -> None:
        score = strassen(self.a["x"], c["x"].T)
        other = self.a["label"][:, None] != c["label"]
        floor = self.heaps.floor().reshape(self.n, self.slots)
        for s in range(self.slots):
            hit = score >= np.maximum(self.lo[:, s], floor[:, s])[:, None]
            hit &= score <= self.hi[:, s, None]
            hit &= other
            p, q = np.nonzero(hit)
            self.heaps.add(p * self.slots + s, score[p, q], c["id"][q], c["row"][q])

    def result(self) -> dict[str, np.ndarray]:
        slot, e = self.heaps.rows()
        return {"anchor": self.a["row"][slot // self.slots], "pos": (slot % self.slots).astype(np.int32), **e}


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int, int], dict[str, np.ndarray]]]:
    """Runs of rows of equal group, length and side, in sorted order; a run
    that batches cut comes in several pieces."""
    for batch in batches:
        c = _columns(batch)
        if not len(c["row"]):
            continue
        change = np.flatnonzero(np.diff(c["grp"]) | np.diff(c["dim"]) | np.diff(c["side"])) + 1
        starts = [0, *change.tolist(), len(c["row"])]
        width = np.concatenate([[0], np.cumsum(c["dim"].astype(np.int64))])
        for lo, hi in zip(starts, starts[1:], strict=False):
            dim = int(c["dim"][lo])
            part = {k: v[lo:hi] for k, v in c.items() if k not in ("flat", "more")}
            part["x"] = c["flat"][width[lo]:width[hi]].reshape(hi - lo, dim)
            part["more"] = c["more"].slice(lo, hi - lo)
            yield (int(c["grp"][lo]), dim, int(c["side"][lo])), part


def _joined(parts: list[dict]) -> dict:
    out = {k: np.concatenate([p[k] for p in parts]) for k in parts[0] if k != "more"}
    return out | {"more": pa.concat_arrays([p["more"] for p in parts])}


OUT = "anchor bigint, pos int, score bigint, id bigint, null boolean, row bigint"


def _mined(spread: DataFrame, make, strip: int) -> DataFrame:
    """Run a tile's heaps over every group of ``spread``, which is sorted by
    group, length and side."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, anchors, tile, nulls = None, [], None, []

        def done() -> Iterator[pa.RecordBatch]:
            if tile is not None:
                r = tile.result()
                null = np.isin(r["row"], np.concatenate(nulls)) if nulls else np.zeros(len(r["row"]), bool)
                yield pa.RecordBatch.from_pydict(
                    {"anchor": r["anchor"], "pos": r["pos"], "score": r["score"], "id": r["id"], "null": null, "row": r["row"]})

        for (grp, dim, side), part in _runs(batches):
            if key != (grp, dim):
                yield from done()
                key, anchors, tile, nulls = (grp, dim), [], None, []
            if side == 0:
                anchors.append(part)
                continue
            if not anchors:
                continue                         # no anchor has this length here
            if tile is None:
                tile = make(_joined(anchors))
            if part["null"].any():
                nulls.append(part["row"][part["null"]])
            for lo, hi in strips(len(part["row"]), strip):
                tile.feed({k: v[lo:hi] for k, v in part.items() if k != "more"})
        yield from done()

    return spread.mapInArrow(lean(run), OUT)


def _grid(rows: DataFrame, anchors: DataFrame, blocks: int, slabs: int) -> DataFrame:
    """Anchors in every slab's group of their block and rows in every
    block's group of their slab, sorted for :func:`_mined`."""
    groups = blocks * slabs
    each = lambda n, to: F.explode(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), to))
    own = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    a = anchors.select(each(slabs, lambda s: own(blocks) * slabs + s).alias("grp"), F.size("q").alias("dim"), F.lit(0).alias("side"),
                       "row", "id", "label", "q", "goals")
    c = rows.select(each(blocks, lambda b: b * slabs + own(slabs)).alias("grp"), F.size("q").alias("dim"), F.lit(1).alias("side"),
                    "row", "id", "label", "q", F.lit(None).cast("array<bigint>").alias("goals"))
    n = min(groups, max(shuffle_partitions(rows.sparkSession), 4096))
    return a.unionByName(c).repartitionById(n, F.col("grp") % n).sortWithinPartitions("grp", "dim", "side", "row")


def _best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Merge the heaps of all tasks: the ``k`` best per key, with ``rank``."""
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), "null", "id", "row")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", label: str | Column = "label",
         scale: int = 256, positives: int = 5, negatives: int = 3, low: tuple[int, int] = (50, 100),
         high: tuple[int, int] = (95, 100), block: int = 1024, strip: int = 2048, slabs: int = 32,
         slab_rows: int = 1 << 20) -> DataFrame:
    """Per anchor and positive the best negatives of the positive's window:
    ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``,
    ``positive_score``, ``negative_score``.

    Components become ``floor(scale * x)``; a score is the integer inner
    product.  ``anchor`` (a condition on ``vectors``) names the anchors; an
    anchor's positives are its best ``positives`` other rows of the same
    ``label``; a negative has another label and a score between ``low`` and
    ``high`` of the positive's, both fractions and both inclusive (none where
    the positive's score is below zero).  Larger scores come first, then
    smaller ids, a null id last.

    Rows with a null label, a null vector or a null or non-finite component
    take no part; nor does a vector whose scaled squared length reaches 2^63,
    as its scores need not fit a long (all others' do, by Cauchy-Schwarz).
    Vectors of different lengths don't meet.  Rows with repeated or null ids
    are rows of their own (a null ``anchor`` is none); other columns are
    ignored; an empty table gives no rows.

    A group holds about ``block`` anchors and one of the slabs: at least
    ``slabs``, more where a slab would exceed ``slab_rows``.  Work is anchors
    times rows, as stated by the query; a group is read as a stream, so its
    memory is the anchors, their heaps and one strip's scores.
    """
    importable(vectors.sparkSession)
    v, lab = F.col(vec_col), F.col(label) if isinstance(label, str) else label
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    grown = lambda x: F.abs(x.cast("double") * float(scale)) + 1.0
    length = F.aggregate(v, F.lit(0.0), lambda s, x: s + grown(x) * grown(x))
    fit = lab.isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(False)) & (length < float(LAST))
    q = F.transform(v, lambda x: F.floor(x.cast("double") * float(scale)).cast("bigint"))
    rows = written(
        vectors.select(F.col(id_col).cast("bigint").alias("id"), lab.cast("bigint").alias("label"),
                       F.coalesce(anchor, F.lit(False)).alias("is_anchor"), F.when(fit, q).alias("q"))
        .where(F.col("q").isNotNull()).withColumn("row", F.monotonically_increasing_id()), "hard-rows")
    anchors = rows.where("is_anchor").drop("is_anchor")
    n_rows, n_anchors = rows.agg(F.count(F.lit(1)), F.count_if("is_anchor")).first()
    blocks, slabs = max(1, -(-n_anchors // block)), max(slabs, -(-n_rows // slab_rows))

    no_goal = anchors.withColumn("goals", F.lit(None).cast("array<bigint>"))
    near = _mined(_grid(rows, no_goal, blocks, slabs), lambda a: Positives(a, positives), strip)
    near = written(_best(near, ["anchor"], positives).withColumn("id", F.when(~F.col("null"), F.col("id"))), "positives")
    goals = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("g"))
    aimed = anchors.join(goals.select(F.col("anchor").alias("row"), F.transform("g", lambda x: x["score"]).alias("goals")), "row")
    far = _mined(_grid(rows, aimed, blocks, slabs), lambda a: Negatives(a, negatives, positives, low, high), strip)
    far = _best(far, ["anchor", "pos"], negatives).withColumn("id", F.when(~F.col("null"), F.col("id")))
    return (far.select("anchor", (F.col("pos") + 1).alias("at"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(near.select("anchor", F.col("rank").alias("at"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
                  ["anchor", "at"])
            .join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))
