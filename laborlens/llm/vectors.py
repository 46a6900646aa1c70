"""Near-duplicate embeddings: spherical k-means cells and blocked cosines.

Equal vectors are one node with a count.  Nodes go to their nearest
centroids' cells (more of them the more cells there are), a cell's nodes to
blocks of bounded size, and every pair of a cell's blocks is one task that
multiplies two small matrices in double precision.  A task returns a row per
node that has links, not per link: how many vectors it links to, and a
smaller node of its local component, which is enough to join components.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import importable, lean, written
from .components import components

STRIP = 1 << 16  # pairs whose cells are compared at once


def unit_rows(flat: np.ndarray, dim: int) -> np.ndarray:
    """Rows of length 1; scaled by their largest component first, so that no
    square over- or underflows."""
    x = flat.reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """``k`` unit centroids of unit rows; the first rows are the start, and a
    cell that loses its members keeps its centroid."""
    c = x[:k].copy()
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        norm = np.sqrt((sums * sums).sum(axis=1))
        c[norm > 0] = sums[norm > 0] / norm[norm > 0, None]
    return c


def fit_cells(nodes: DataFrame, cell_rows: int, sample: int, max_cells: int) -> dict[int, np.ndarray]:
    """Centroids per vector length, from the ``sample`` nodes with the
    smallest hashes (a documented bound: only they come to the driver)."""
    n = nodes.count()
    got = nodes.orderBy(F.xxhash64("vec"), "node").limit(sample).select("vec").toArrow().column("vec").combine_chunks()
    by: dict[int, list] = {}
    for v in got:
        by.setdefault(len(v), []).append(v.values.to_numpy())
    out = {}
    for dim, rows in by.items():
        k = -(-n * len(rows) // max(1, len(got)) // cell_rows)
        out[dim] = spherical_kmeans(unit_rows(np.concatenate(rows), dim), max(1, min(k, max_cells, len(rows))))
    return out


def probes_of(cells: int, probes: int) -> int:
    """Cells that a node probes: ``probes``, and one more beyond 64 cells and
    for every further factor of four, as a pair shares a cell less often the
    more cells there are."""
    more = 0
    while cells > 64 << 2 * more:
        more += 1
    return min(probes + more, cells)


def assign(nodes: DataFrame, cells: dict[int, np.ndarray], probes: int) -> DataFrame:
    """A row per node and probed cell: ``dim``, ``cell``, ``probed`` (all the
    node's cells), ``node``, ``n``, ``vec``."""
    shared = nodes.sparkSession.sparkContext.broadcast(cells)
    schema = pa.schema([("dim", pa.int32()), ("cell", pa.int32()), ("probed", pa.list_(pa.int32())),
                        ("node", pa.int64()), ("n", pa.int64()), ("vec", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column("vec").offsets.to_numpy())
            for dim in np.unique(sizes).tolist():
                part = batch.take(pa.array(np.flatnonzero(sizes == dim)))
                x = unit_rows(part.column("vec").flatten().to_numpy(), dim)
                c = shared.value.get(dim, np.zeros((1, dim)))
                m = probes_of(len(c), probes)
                sim = x @ c.T
                near = np.argpartition(-sim, m - 1, axis=1)[:, :m] if m < len(c) else np.tile(np.arange(m), (len(x), 1))
                pick, flat = np.repeat(np.arange(len(x)), m), near.astype(np.int32).reshape(-1)
                own = part.take(pa.array(pick))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pick), dim, np.int32)), pa.array(flat),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(pick) + 1, dtype=np.int32) * m),
                                              pa.array(near.astype(np.int32)[pick].reshape(-1))),
                     own.column("node"), own.column("n"), own.column("vec")], schema=schema)

    return nodes.select("node", "n", "vec").mapInArrow(
        lean(run), "dim int, cell int, probed array<int>, node bigint, n bigint, vec array<double>")


def compare(rows: dict[str, np.ndarray], cell: int, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links among the rows of one pair of blocks: nodes, how many vectors
    each links to, and a node of its local component.

    A pair counts in the smallest cell that both probe.
    """
    a = np.flatnonzero(rows["side"] == 0)
    b = a if same else np.flatnonzero(rows["side"] == 1)
    x, probed = rows["x"], rows["probed"]
    i, j = np.nonzero(x[a] @ x[b].T >= threshold)
    i, j = a[i], b[j]
    if same:
        i, j = i[i < j], j[i < j]
    here = np.empty(len(i), bool)
    for at in range(0, len(i), STRIP):
        p, q = probed[i[at:at + STRIP]], probed[j[at:at + STRIP]]
        met = (p[:, :, None] == q[:, None, :]).any(axis=2)     # which of the first's cells the second probes too
        here[at:at + STRIP] = ~(met & (p < cell)).any(axis=1)
    i, j = i[here], j[here]
    m = len(x)
    links = np.zeros(m, np.int64)
    np.add.at(links, i, rows["n"][j])
    np.add.at(links, j, rows["n"][i])
    root = np.arange(m)
    while len(i):                                              # smallest row index over links, with short cuts
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    hit = np.flatnonzero(links)
    return rows["node"][hit], links[hit], rows["node"][root[hit]]


def link_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.95,
                 cell_rows: int = 512, probes: int = 3, sample: int = 16_384, max_cells: int = 4096,
                 block: int = 1024) -> DataFrame:
    """Per row: ``id_col``, ``n_links`` (other vectors of cosine
    ``threshold`` or more, as found), ``component_id`` (the smallest id that
    links reach), ``kept`` (whether that is the row's own id).

    Every pair of equal vectors is found, and every pair that probes a common
    cell; a pair that has none is missed (tests measure the recall).  Of up
    to 64 cells a node probes the nearest ``probes``, of more cells more.
    Vectors that are null or empty, zero, or hold a null or non-finite
    component link with nothing; vectors of different lengths don't link.
    Repeated rows are vectors of their own and link with each other; other
    columns are ignored.
    """
    spark = vectors.sparkSession
    importable(spark)
    v = F.col("vec")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fit = v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.select("id", F.when(fit, v).alias("vec"))
    nodes = written(rows.where(v.isNotNull()).groupBy("vec").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
                    .withColumn("node", F.monotonically_increasing_id()), "vectors")
    cells = fit_cells(nodes, cell_rows, sample, max_cells)
    probed = written(assign(nodes, cells, probes), "cells")
    # a row per cell: bounded by max_cells and the number of vector lengths
    blocks = probed.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    spread = (probed.join(F.broadcast(blocks), ["dim", "cell"]).withColumn("own", own)
              .withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("dim", "cell", F.least("own", "mate").alias("lo"), F.greatest("own", "mate").alias("hi"),
                      (F.col("own") > F.col("mate")).cast("int").alias("side"), "probed", "node", "n", "vec"))

    def task(key: tuple, table: pa.Table) -> pa.Table:
        dim, cell, lo, hi = (k.as_py() for k in key)
        flat = lambda name: table.column(name).combine_chunks().flatten().to_numpy()
        got = {"x": unit_rows(flat("vec"), dim), "probed": flat("probed").reshape(table.num_rows, -1),
               **{c: table.column(c).to_numpy() for c in ("side", "node", "n")}}
        return pa.table(dict(zip(("node", "links", "root"), compare(got, cell, lo == hi, threshold), strict=True)))

    found = written(spread.groupBy("dim", "cell", "lo", "hi").applyInArrow(lean(task), "node bigint, links bigint, root bigint"), "links")
    hung = components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))).withColumnRenamed("root", "top")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    rooted = nodes.join(hung, "node", "left").join(links, "node", "left").withColumn("top", F.coalesce("top", "node"))
    first = rooted.groupBy("top").agg(F.min("least").alias("component_id"))
    named = written(rooted.join(first, "top").select(
        "vec", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"), "named")
    out = rows.join(named, "vec", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
