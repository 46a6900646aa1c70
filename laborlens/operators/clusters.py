"""K-means over counted vectors, all starts of all k at once.

A start is some twenty short passes over the same points, so as Spark jobs
the starts of a sweep are mostly waiting.  Equal vectors are one point with
the number of their rows; while the points fit one task, they are shuffled
to a few tasks as lists of their values that are not 0, and each task runs
its share of the starts.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Points:
    """Sparse rows ``x`` (number of values, their positions, the values) that
    stand for ``w`` rows each."""

    def __init__(self, number: np.ndarray, at: np.ndarray, value: np.ndarray, w: np.ndarray, p: int):
        self.number, self.at, self.value, self.w, self.p = number, at, value, w, p
        self.row = np.repeat(np.arange(len(w)), number)
        self.square = np.bincount(self.row, value * value, len(w))

    def distances(self, c: np.ndarray) -> np.ndarray:
        """Squared distances to one centre."""
        return np.maximum(self.square - 2 * np.bincount(self.row, self.value * c[self.at], len(self.w)) + c @ c, 0.0)

    def nearest(self, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each row the squared distance to the nearest centre and which."""
        near, label = np.full(len(self.w), np.inf), np.zeros(len(self.w), np.int64)
        for j, c in enumerate(centres):
            d = self.distances(c)
            label[d < near] = j
            near = np.minimum(near, d)
        return near, label

    def sums(self, label: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Weight and weighted sum of each cluster."""
        s = np.bincount(label[self.row] * self.p + self.at, self.value * self.w[self.row], k * self.p)
        return np.bincount(label, self.w, k), s.reshape(k, self.p)

    def dense(self, rows: np.ndarray) -> np.ndarray:
        x = np.zeros((len(rows), self.p))
        for r, i in zip(x, rows, strict=True):
            own = slice(*np.searchsorted(self.row, [i, i + 1]))
            r[self.at[own]] = self.value[own]
        return x

    def start(self, k: int, rng: np.random.Generator, steps: int = 2) -> np.ndarray:
        """k-means||, as MLlib starts: each of ``steps`` rounds adds some 2k
        rows by their distance from the centres so far; they, weighted by the
        rows that are nearest to them, are clustered from k-means++ seeds."""
        rows = np.array([rng.choice(len(self.w), p=self.w / self.w.sum())])
        near = self.distances(self.dense(rows)[0])
        for _ in range(steps):
            cost = near * self.w
            drawn = np.flatnonzero(rng.random(len(cost)) * cost.sum() < 2 * k * cost)
            near = np.minimum(near, self.nearest(self.dense(drawn))[0])
            rows = np.concatenate([rows, drawn])
        x = np.unique(self.dense(rows), axis=0)
        if len(x) <= k:
            return x
        number = np.count_nonzero(x, axis=1)
        few = Points(number, np.nonzero(x)[1], x[np.nonzero(x)], np.bincount(self.nearest(x)[1], self.w, len(x)), self.p)
        return few.lloyd(few.seeds(k, rng), 30)[1]

    def seeds(self, k: int, rng: np.random.Generator) -> np.ndarray:
        """k-means++: each centre is a row drawn by its squared distance from
        those before; fewer where all rows are centres."""
        rows = [rng.choice(len(self.w), p=self.w / self.w.sum())]
        near = self.distances(self.dense(np.array(rows))[0])
        while len(rows) < k and (cost := near * self.w).sum() > 0:
            rows.append(rng.choice(len(cost), p=cost / cost.sum()))
            near = np.minimum(near, self.distances(self.dense(np.array(rows[-1:]))[0]))
        return self.dense(np.array(rows))

    def lloyd(self, c: np.ndarray, rounds: int = 20, tol: float = 1e-4) -> tuple[float, np.ndarray]:
        """Cost and centres after at most ``rounds`` rounds; less if no centre
        moves by more than ``tol``.  A cluster without rows keeps its centre."""
        for _ in range(rounds):
            n, s = self.sums(self.nearest(c)[1], len(c))
            new = np.where(n[:, None] > 0, s / np.where(n > 0, n, 1)[:, None], c)
            moved, c = ((new - c) ** 2).sum(1).max(), new
            if moved <= tol * tol:
                break
        return float((self.nearest(c)[0] * self.w).sum()), c

    def silhouette(self, c: np.ndarray) -> float:
        """Mean silhouette of the rows by squared distances, as MLlib has it:
        a row alone in its cluster has 0.  NaN where there is one cluster."""
        label = self.nearest(c)[1]
        n, s = self.sums(label, len(c))
        used = np.flatnonzero(n)
        if len(used) < 2:
            return float("nan")
        n, mean, label = n[used], s[used] / n[used, None], np.searchsorted(used, label)
        square = np.bincount(label, self.w * self.square, len(used)) / n
        mean_d = np.stack([self.distances(m) + v - m @ m for m, v in zip(mean, square, strict=True)])
        every = np.arange(len(self.w))
        own = mean_d[label, every] * n[label] / np.where(n[label] > 1, n[label] - 1, 1)
        mean_d[label, every] = np.inf
        other = mean_d.min(0)
        most = np.maximum(own, other)
        score = np.where((n[label] > 1) & (most > 0), (other - own) / np.where(most > 0, most, 1), 0.0)
        return float((score * self.w).sum() / self.w.sum())


def fits_one_task(vectors: DataFrame, features: str = "features", most: int = 8_000_000) -> bool:
    """Whether all vectors have at most ``most`` values that are not 0."""
    from pyspark.ml.functions import vector_to_array

    n = vectors.agg(F.sum(F.size(F.filter(vector_to_array(features), lambda x: x != 0)))).first()[0]
    return n is not None and n <= most


def best_starts(vectors: DataFrame, ks: Sequence[int], n_init: int, seed: int, features: str = "features", weight: str = "_rows") -> dict:
    """Per k the (cost, silhouette, centres) of the best of ``n_init`` starts
    over counted vectors, whatever their layout."""
    from pyspark.ml.functions import vector_to_array

    jobs = [(k, i) for k in sorted(ks, reverse=True) for i in range(n_init)]
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    groups = min(len(jobs), 2 * cores)
    p = vectors.first()[features].size

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, p)
            row, at = np.nonzero(x)
            parts = [np.bincount(row, minlength=len(x)).astype(np.int32), at.astype(np.int32), x[row, at],
                     b.column("w").to_numpy(), b.column("h").to_numpy()]
            yield pa.RecordBatch.from_arrays([pa.array(range(groups), pa.int32()), *[pa.array([v.tobytes()] * groups, pa.binary()) for v in parts]],
                                             names=["g", "number", "at", "value", "w", "h"])

    def run(t: pa.Table) -> pa.Table:
        number, at, value, w, h = (np.frombuffer(b"".join(t.column(c).to_pylist()), d)
                                   for c, d in (("number", np.int32), ("at", np.int32), ("value", float), ("w", float), ("h", np.int64)))
        order = np.argsort(h, kind="stable")            # draws do not depend on the order of arrival
        ends = np.cumsum(number)
        take = np.repeat((ends - number)[order], number[order]) + np.arange(len(at)) - np.repeat(np.cumsum(number[order]) - number[order], number[order])
        points = Points(number[order], at[take], value[take], w[order], p)
        found = []
        for k, i in jobs[t.column("g")[0].as_py()::groups]:
            cost, c = points.lloyd(points.start(k, np.random.default_rng([seed, k, i])))
            found.append((k, i, cost, points.silhouette(c), c.tolist()))
        return pa.table([pa.array(x, d) for x, d in zip(zip(*found, strict=True), (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.list_(pa.float64()))), strict=True)],
                        names=["k", "start", "cost", "silhouette", "centres"])

    x = vector_to_array(features)
    dealt = vectors.select(x.alias("x"), F.col(weight).cast("double").alias("w"), F.xxhash64(x).alias("h")).mapInArrow(
        deal, "g int, number binary, at binary, value binary, w binary, h binary")
    found = dealt.repartition(8 * cores, "g").groupBy("g").applyInArrow(
        run, "k int, start int, cost double, silhouette double, centres array<array<double>>").collect()
    best: dict = {}
    for r in sorted(found, key=lambda r: (r["cost"], r["start"])):
        best.setdefault(r["k"], (r["cost"], r["silhouette"], np.array(r["centres"])))
    return best


def model_of(spark, centres: np.ndarray):
    """An MLlib model with these centres."""
    from pyspark.ml.clustering import KMeansModel

    jvm = spark.sparkContext._jvm
    rows = spark.sparkContext._gateway.new_array(jvm.org.apache.spark.mllib.linalg.Vector, len(centres))
    for i, c in enumerate(centres):
        values = spark.sparkContext._gateway.new_array(jvm.double, len(c))
        for j, x in enumerate(c):
            values[j] = float(x)
        rows[i] = jvm.org.apache.spark.mllib.linalg.Vectors.dense(values)
    return KMeansModel(jvm.org.apache.spark.ml.clustering.KMeansModel("kmeans", jvm.org.apache.spark.mllib.clustering.KMeansModel(rows)))
