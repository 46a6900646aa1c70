"""M4: a forest of regression trees, grown and scored together.

Trees of depth 30 have about as many nodes as there are different feature
vectors, so neither dense statistics per open node nor the forest itself fit
one machine.  Rows are first counted per feature vector: a table of points
with each tree's bootstrap weight and label sum.  Where there are more than
``most`` points the top of every tree is grown level by level from histograms
that the partitions make and Spark adds; as soon as a node has at most
``most`` points they are shuffled by tree and node, and the subtree below is
grown, and its points are scored, in one task.  Fewer points are shuffled by
some trees at a time, which one task grows whole.  What stays is a prediction
per point and the importances.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage

OPEN, LEAF, LOCAL, SPLIT = range(4)


class Forest:
    """Predictions of the points that a forest was asked for."""

    def __init__(self, scores: DataFrame, importances: np.ndarray, features: str):
        self.scores, self.importances, self.features = scores, importances, features

    @property
    def featureImportances(self):
        from pyspark.ml.linalg import Vectors

        return Vectors.dense(self.importances)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.join(self.scores, self.features, "left").select(*df.columns, "prediction")

    def save(self, path: str) -> None:
        spark = self.scores.sparkSession
        spark.createDataFrame([(self.features, self.importances.tolist())], "features string, importances array<double>") \
            .coalesce(1).write.mode("overwrite").parquet(f"{path}/about")
        self.scores.write.mode("overwrite").parquet(f"{path}/data")

    @classmethod
    def load(cls, spark, path: str) -> Forest:
        r = spark.read.parquet(f"{path}/about").first()
        return cls(spark.read.parquet(f"{path}/data"), np.array(r["importances"]), r["features"])


class Bins:
    """Where the bins of each feature lie in a row of a histogram."""

    def __init__(self, cuts: list[np.ndarray]):
        self.cuts = cuts
        self.n = np.array([len(c) + 1 for c in cuts])
        self.first = np.concatenate([[0], np.cumsum(self.n)[:-1]]).astype(np.int64)
        self.total = int(self.n.sum())
        self.feature = np.repeat(np.arange(len(cuts)), self.n)
        self.bin = np.arange(self.total) - self.first[self.feature]
        self.ends = np.flatnonzero(self.bin < self.n[self.feature] - 1)      # a split may come after these
        self.many = np.flatnonzero(self.n > 2)
        self.end_of = np.full(self.total, -1)                                # of the second of two bins: the only end
        two = np.flatnonzero(self.n[self.feature[self.ends]] == 2)
        self.end_of[self.ends[two] + 1] = two

    def entries(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and place of each code that is not 0."""
        row, f = np.nonzero(code)
        return row, self.first[f] + code[row, f]

    def lists(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of codes that are not 0 per row, and their places."""
        row, place = self.entries(code)
        return np.bincount(row, minlength=len(code)), place.astype(np.int32)

    def tally(self, node: np.ndarray, n: int, number: np.ndarray, place: np.ndarray, values, most: int = 1 << 18) -> list[np.ndarray]:
        """Sums of each of ``values`` per node (``n`` of them) and place, but
        nothing in bin 0.  ``number``, ``place``: :meth:`lists` of the rows,
        of which ``most`` are unfolded at a time."""
        out, ends = None, np.concatenate([[0], np.cumsum(number)])
        for i in range(0, max(len(node), 1), most):
            k = number[i:i + most]
            at = np.repeat(node[i:i + most] * self.total, k) + place[ends[i]:ends[min(i + most, len(node))]]
            got = [np.bincount(at, np.repeat(v[i:i + most], k), n * self.total) for v in values]
            out = got if out is None else [a + b for a, b in zip(out, got, strict=True)]
        return [h.reshape(n, self.total) for h in out]

    def choose(self, w: np.ndarray, s: np.ndarray, wt: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and gain of each node's best split, as :meth:`best`, from
        its sums by :meth:`tally` and in all.  Of a feature with two bins only
        those nodes are looked at that have weight in both."""
        def filled(h, t, f):
            own = h[:, self.first[f]:self.first[f] + self.n[f]].copy()
            own[:, 0] = t - np.add.reduceat(own, [0], axis=1)[:, 0]
            return own

        n = len(wt)
        if not len(self.ends):
            return np.zeros(n, np.int64), np.zeros(n)
        st = filled(s, total, 0).sum(1)
        parts = np.full((n, len(self.ends)), -1.0)
        node, place = np.nonzero(w)
        wr, end = w[node, place], self.end_of[place]
        ok = (end >= 0) & (wr < wt[node])
        node, place, end, wr = node[ok], place[ok], end[ok], wr[ok]
        sl = total[node] - s[node, place]
        sr = st[node] - sl
        parts[node, end] = sl * sl / (wt[node] - wr) + sr * sr / wr
        for f in self.many:
            wl, sl = (filled(h, t, f) for h, t in ((w, wt), (s, total)))
            for j in range(1, self.n[f]):
                wl[:, j] += wl[:, j - 1]
                sl[:, j] += sl[:, j - 1]
            wl, sl = wl[:, :-1], sl[:, :-1]
            wr, sr = wt[:, None] - wl, st[:, None] - sl
            ok = (wl > 0) & (wr > 0)
            at = int(np.searchsorted(self.ends, self.first[f]))
            parts[:, at:at + self.n[f] - 1] = np.where(ok, sl * sl / np.where(ok, wl, 1) + sr * sr / np.where(ok, wr, 1), -1.0)
        k = parts.argmax(1)
        most = parts[np.arange(n), k]
        gain = most - st * st / wt
        return self.ends[k], np.where((most >= 0) & (gain > 1e-12 * most), gain, 0.0)      # less is rounding

    def sums(self, node: np.ndarray, n: int, row: np.ndarray, place: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Sums of ``v`` per node (``n`` of them) and place; bin 0 of a
        feature has what its other bins leave."""
        h = np.bincount(node[row] * self.total + place, v[row], n * self.total).reshape(n, self.total)
        h[:, self.first] = np.bincount(node, v, n)[:, None] - np.add.reduceat(h, self.first, axis=1)
        return h

    def best(self, w: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, ...]:
        """Per node: weight, sum, and of its best split the place, the gain
        (less squared error; 0 without a split) and the sums on its left."""
        wt, st = w[:, :self.n[0]].sum(1), s[:, :self.n[0]].sum(1)
        if not len(self.ends):
            none = np.zeros(len(w))
            return wt, st, none.astype(np.int64), none, none, none
        wl, sl = w.copy(), s.copy()
        for j in range(1, int(self.n.max())):
            at = self.first[self.n > j] + j
            wl[:, at] += wl[:, at - 1]
            sl[:, at] += sl[:, at - 1]
        wl, sl = wl[:, self.ends], sl[:, self.ends]
        wr, sr = wt[:, None] - wl, st[:, None] - sl
        ok = (wl > 0) & (wr > 0)
        parts = np.where(ok, sl * sl / np.where(ok, wl, 1) + sr * sr / np.where(ok, wr, 1), -1.0)
        k, at = parts.argmax(1), np.arange(len(w))
        most = parts[at, k]
        gain = most - st * st / np.where(wt > 0, wt, 1)
        gain = np.where((most >= 0) & (gain > 1e-12 * most), gain, 0.0)      # less is rounding
        return wt, st, self.ends[k], gain, wl[at, k], sl[at, k]


def grow(bins: Bins, code: np.ndarray, w: np.ndarray, s: np.ndarray, depth: int, max_depth: int,
         lists: tuple[np.ndarray, np.ndarray] | None = None, direct: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """The subtree of a node at ``depth``, all nodes of a level at once: the
    leaf mean of every row (rows of weight 0 are only scored) and the gain
    per feature.  ``lists``: of ``code``, where they are there already.

    Of two children the larger has what the smaller leaves of the parent's
    sums, if it has more than ``direct`` rows; others are summed."""
    value, gains = np.zeros(len(code)), np.zeros(len(bins.n))
    number, place = bins.lists(code) if lists is None else lists
    live, idle = np.flatnonzero(w > 0), np.flatnonzero(w <= 0)
    place, number, w, s = place[np.repeat(w > 0, number)], number[live], w[live].astype(float), s[live].astype(float)
    node, below, n, held = np.zeros(len(live), np.int64), np.zeros(len(idle), np.int64), 1, None
    while len(live):
        rows = np.bincount(node, minlength=n)
        wt, total = (np.bincount(node, v, n) for v in (w, s))
        mean = total / np.where(wt > 0, wt, 1)
        split, cut = np.zeros(n, bool), np.zeros(n, np.int64)
        may = np.flatnonzero(rows > 1) if depth < max_depth else np.zeros(0, np.int64)
        if len(may):
            made, rest = np.zeros(n, bool), may[:0]
            made[may] = True
            if held is not None:
                other = rows[may ^ 1]
                rest = may[(rows[may] > direct) & ((rows[may] > other) | ((rows[may] == other) & (may % 2 == 0)))]
                made[rest], made[rest ^ 1] = False, True
            slot = np.cumsum(made) - 1
            if made.all():
                sums = bins.tally(node, n, number, place, (w, s))
            else:
                i = made[node]
                sums = bins.tally(slot[node[i]], int(made.sum()), number[i], place[np.repeat(i, number)], (w[i], s[i]))
            if len(rest):
                own, at = made[may], np.searchsorted(may, rest)
                every = [np.empty((len(may), bins.total)) for _ in sums]
                for e, h, parent in zip(every, sums, held, strict=True):
                    e[own], e[at] = h[slot[may[own]]], parent[rest // 2] - h[slot[rest ^ 1]]
                sums = every
            elif len(may) < n:
                sums = [h[slot[may]] for h in sums]
            cut[may], gain = bins.choose(*sums, wt[may], total[may])
            split[may] = gain > 0
            np.add.at(gains, bins.feature[cut[may[gain > 0]]], gain[gain > 0])
            large = (rows[split] > direct).any()
            held = [h[gain > 0] for h in sums] if large else None
        f, bin_, child = bins.feature[cut], bins.bin[cut], 2 * (np.cumsum(split) - 1)
        on = split[node]
        if not on.all():
            value[live[~on]] = mean[node[~on]]
            place = place[np.repeat(on, number)]
            live, node, number, w, s = live[on], node[on], number[on], w[on], s[on]
        node = child[node] + (code[live, f[node]] > bin_[node])
        on = split[below]
        if not on.all():
            value[idle[~on]] = mean[below[~on]]
            idle, below = idle[on], below[on]
        below = child[below] + (code[idle, f[below]] > bin_[below])
        n, depth = 2 * int(split.sum()), depth + 1
    return value, gains


def descend(code: np.ndarray, top: dict) -> np.ndarray:
    """The node of a tree's top that each row comes to."""
    node = np.zeros(len(code), np.int64)
    while True:
        i = np.flatnonzero(top["kind"][node] == SPLIT)
        if not len(i):
            return node
        at = node[i]
        node[i] = top["left"][at] + (code[i, top["feature"][at]] > top["bin"][at])


def cut_points(points: DataFrame, features: str, p: int, most: int = 32, exact: bool = False) -> list[np.ndarray] | None:
    """Per feature the values that a split may lie at: between all values
    where there are at most ``most``, else at as many quantiles (None if
    ``exact``)."""
    from pyspark.ml.functions import vector_to_array

    long = points.select(F.posexplode(vector_to_array(features)).alias("f", "x"))
    values = long.distinct()
    few = [r["f"] for r in values.groupBy("f").count().where(F.col("count") <= most).collect()]
    if exact and len(few) < p:
        return None
    cuts = [np.zeros(0)] * p
    got: dict[int, list] = {}
    for r in values.where(F.col("f").isin(few)).collect() if few else []:
        got.setdefault(r["f"], []).append(r["x"])
    for f, xs in got.items():
        xs = np.sort(np.array(xs) + 0.0)
        cuts[f] = np.unique((xs[1:] + xs[:-1]) / 2)
    if len(few) < p:
        at = F.percentile_approx("x", [(i + 1) / most for i in range(most - 1)], 10_000)
        for r in long.where(~F.col("f").isin(few)).groupBy("f").agg(at.alias("q")).collect():
            cuts[r["f"]] = np.unique(r["q"])
    return cuts


def _matrix(column, dtype, width: int) -> np.ndarray:
    """Rows of a binary column, null: zeros."""
    none = bytes(width * np.dtype(dtype).itemsize)
    return np.frombuffer(b"".join(none if x is None else x for x in column.to_pylist()), dtype).reshape(-1, width)


def _batch(names: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in names.values()], names=list(names))


def _rows(m: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in m], pa.binary())


def asked(train: DataFrame, rows: DataFrame | None, features: str) -> DataFrame:
    """The different feature vectors of both tables, with an id."""
    both = train.select(features) if rows is None else train.select(features).union(rows.select(features))
    return stage(both.distinct().withColumn("id", F.monotonically_increasing_id()), "forest-points")


def encoded(points: DataFrame, features: str, bins: Bins) -> DataFrame:
    """The codes of ``points``: per feature the number of cuts below."""
    from pyspark.ml.functions import vector_to_array

    p = len(bins.n)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, p)
            code = np.zeros(x.shape, np.uint8)
            for f, c in enumerate(bins.cuts):
                code[:, f] = np.searchsorted(c, x[:, f])
            yield _batch({"id": b.column("id"), "code": _rows(code)})

    return points.select("id", vector_to_array(features).alias("x")).mapInArrow(encode, "id bigint, code binary")


def bagged(train: DataFrame, label: str, mean: float, trees: int, seed: int) -> DataFrame:
    """Per point the weight and the label sum in each tree's bootstrap: every
    row counts Poisson(1) times.  ``train``: id of the point, label."""
    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            ids, y = b.column(0).to_numpy(), b.column(1).to_numpy() - mean
            k = rng.poisson(1.0, (len(ids), trees)).astype(float)
            at = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            u, w, s = ids[at], np.add.reduceat(k, at), np.add.reduceat(k * y[:, None], at)
            if held is not None:
                if held[0][0] == u[0]:
                    w[0] += held[1][0]
                    s[0] += held[2][0]
                else:
                    u, w, s = (np.concatenate(x) for x in zip(held, (u, w, s), strict=True))
            yield _batch({"id": u[:-1], "w": _rows(w[:-1]), "s": _rows(s[:-1])})
            held = u[-1:], w[-1:], s[-1:]
        if held is not None:
            yield _batch({"id": held[0], "w": _rows(held[1]), "s": _rows(held[2])})

    rows = train.select("id", F.col(label).cast("double").alias("y")).repartition("id").sortWithinPartitions("id", "y")
    return rows.mapInArrow(bag, "id bigint, w binary, s binary")


def crown(table: DataFrame, bins: Bins, trees: int, n_points: int, max_depth: int, most: int) -> tuple[list[dict], np.ndarray]:
    """The top of every tree, down to nodes of at most ``most`` points, and
    the gain per tree and feature.  A pass over the points per level."""
    p = len(bins.n)
    start = OPEN if n_points > most else LOCAL
    tops = [{"kind": [start], "feature": [0], "bin": [0], "left": [0], "value": [0.0], "depth": [0]} for _ in range(trees)]
    gains = np.zeros((trees, p))

    def best(t: pa.Table) -> pa.Table:
        h = sum(np.frombuffer(x, float) for x in t.column("h").to_pylist()).reshape(3, 1, bins.total)
        wt, st, cut, gain, wl, sl = (x[0] for x in bins.best(h[0], h[1]))
        f, b = int(bins.feature[cut]), int(bins.bin[cut])
        own = h[2, 0, bins.first[f]:bins.first[f] + bins.n[f]]
        return pa.table({"tree": t.column("tree")[:1], "node": t.column("node")[:1], "feature": pa.array([f], pa.int32()),
                         "bin": pa.array([b], pa.int32()), "gain": [float(gain)], "w": [float(wt)], "s": [float(st)], "wl": [float(wl)],
                         "sl": [float(sl)], "nl": [float(own[:b + 1].sum())], "nr": [float(own[b + 1:].sum())]})

    for _ in range(max_depth):
        now = [{k: np.array(v) for k, v in t.items()} for t in tops]
        open_ = [np.flatnonzero(t["kind"] == OPEN) for t in now]
        if not any(len(o) for o in open_):
            break

        def count(batches: Iterator[pa.RecordBatch], now=now, open_=open_) -> Iterator[pa.RecordBatch]:
            acc: dict[int, np.ndarray] = {}
            for b in batches:
                if not b.num_rows:
                    continue
                code = _matrix(b.column("code"), np.uint8, p)
                w, s = (_matrix(b.column(c), float, trees) for c in ("w", "s"))
                row, place = bins.entries(code)
                for t in range(trees):
                    n = len(open_[t])
                    if not n:
                        continue
                    slot = np.full(len(now[t]["kind"]), n)
                    slot[open_[t]] = np.arange(n)
                    at = slot[descend(code, now[t])]
                    inside = at < n
                    h = np.stack([bins.sums(at, n + 1, row, place, np.where(inside, v, 0.0))[:n] for v in (w[:, t], s[:, t], np.ones(len(code)))], axis=1)
                    acc[t] = acc[t] + h if t in acc else h
            for t, h in acc.items():
                yield _batch({"tree": pa.array([t] * len(h), pa.int32()), "node": pa.array(open_[t], pa.int32()), "h": _rows(h)})

        found = table.mapInArrow(count, "tree int, node int, h binary").groupBy("tree", "node").applyInArrow(
            best, "tree int, node int, feature int, bin int, gain double, w double, s double, wl double, sl double, nl double, nr double").collect()
        for r in found:
            t, i = tops[r["tree"]], r["node"]
            t["value"][i] = r["s"] / r["w"] if r["w"] else 0.0
            if r["gain"] <= 0:
                t["kind"][i] = LEAF
                continue
            gains[r["tree"], r["feature"]] += r["gain"]
            t["kind"][i], t["feature"][i], t["bin"][i], t["left"][i] = SPLIT, r["feature"], r["bin"], len(t["kind"])
            depth = t["depth"][i] + 1
            for w, s, n in ((r["wl"], r["sl"], r["nl"]), (r["w"] - r["wl"], r["s"] - r["sl"], r["nr"])):
                t["kind"].append(LEAF if depth == max_depth else LOCAL if n <= most else OPEN)
                t["value"].append(s / w)
                t["depth"].append(depth)
                for c in ("feature", "bin", "left"):
                    t[c].append(0)
    return [{k: np.array(v) for k, v in t.items()} for t in tops], gains


def boost(train: DataFrame, label: str, weight: str, rows: DataFrame | None = None, rounds: int = 100, step: float = 0.1,
          depth: int = 3, features: str = "features", most: int = 600_000, levels: int = 32) -> Forest | None:
    """Gradient boosting of a squared loss over ``train``, a row per feature
    vector, as MLlib defines it: the first tree fits the label, each other one
    twice what is left of it and counts ``step`` times.  Trees of a few levels
    over counted vectors are a short sequence of small steps, so one task
    makes them all.  None where that does not hold: over ``most`` vectors, or
    a feature with more than ``levels`` values, which MLlib cuts by a sample."""
    points = asked(train, rows, features)
    n, first, mean = points.count(), points.first(), train.agg(F.avg(label)).first()[0]
    if n > most or mean is None:
        return None
    cuts = cut_points(train, features, first[features].size, levels, exact=True)
    if cuts is None:
        return None
    bins = Bins(cuts)
    p = len(bins.n)
    known = points.join(train.select(features, F.col(label).cast("double").alias("y"), F.col(weight).cast("double").alias("w")), features)
    table = encoded(points, features, bins).join(known.select("id", "y", "w"), "id", "left").coalesce(1)

    def all_rounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column("id").to_numpy(), _matrix(b.column("code"), np.uint8, p), *(b.column(c).fill_null(0.0).to_numpy() for c in ("y", "w")))
                for b in batches if b.num_rows]
        if not held:
            return
        ids, code, y, w = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        order = np.argsort(ids)
        ids, code, y, w = ids[order], code[order], y[order], w[order]
        lists, y = bins.lists(code), np.where(w > 0, y - mean, 0.0)
        total, left, gains = np.zeros(len(ids)), y, np.zeros(p)
        for k in range(rounds):
            value, own = grow(bins, code, w, w * left, 0, depth, lists)
            total += (step if k else 1.0) * value
            left = 2 * (y - total)
            gains += own / (own.sum() or 1.0)
        for i in range(0, len(ids), 10_000):
            yield _batch({"id": ids[i:i + 10_000], "prediction": total[i:i + 10_000] + mean, "gains": pa.array(
                [gains.tolist() if k == 0 else None for k in range(i, min(i + 10_000, len(ids)))], pa.list_(pa.float64()))})

    done = stage(table.mapInArrow(all_rounds, "id bigint, prediction double, gains array<double>"), "boosted")
    gains = np.array(done.where(F.col("gains").isNotNull()).first()["gains"])
    scores = stage(points.join(done, "id").select(features, "prediction"), "forest-scores")
    return Forest(scores, gains / gains.sum() if gains.sum() > 0 else gains, features)


def fit(train: DataFrame, label: str, rows: DataFrame | None = None, trees: int = 100, max_depth: int = 30,
        features: str = "features", seed: int = 0, most: int = 600_000) -> Forest:
    """A forest over ``train`` (all features at each split, bootstrap per
    tree) with predictions for the vectors of ``train`` and ``rows``."""
    spark = train.sparkSession
    train = train.where(F.col(label).isNotNull())
    points = asked(train, rows, features)
    n, first = points.count(), points.first()
    mean = train.agg(F.avg(label)).first()[0]
    if mean is None:
        return Forest(points.select(features, F.lit(None).cast("double").alias("prediction")), np.zeros(first[0].size if first else 0), features)
    p = first[features].size
    bins = Bins(cut_points(points, features, p))

    cores = spark.sparkContext.defaultParallelism
    coded = encoded(points, features, bins)
    bag = bagged(train.join(points, features).select("id", label), label, mean, trees, seed)
    parts = max(1, min(n // 1000, 3 * cores), n // 50_000)
    table = stage(coded.join(bag, "id", "left").repartition(parts, "id"), "forest-rows")
    tops, gains = crown(table, bins, trees, n, max_depth, most)

    together = 1 if n > most else max(1, min(-(-trees // (4 * cores)), 2_000_000 // n))     # whole trees that a task grows

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            code, ids = _matrix(b.column("code"), np.uint8, p), b.column("id").to_numpy()
            w, s = (_matrix(b.column(c), float, trees) for c in ("w", "s"))
            for t in range(0, trees, together):
                if n > most:
                    node = descend(code, tops[t])
                    order = np.argsort(node, kind="stable")
                    nodes, at = np.unique(node[order], return_index=True)
                    parts = [(k, i) for k, i in zip(nodes.tolist(), np.split(order, at[1:]), strict=True) if tops[t]["kind"][k] == LOCAL]
                else:
                    parts = [(0, slice(None))]
                if parts:
                    yield _batch({"tree": pa.array([t] * len(parts), pa.int32()), "node": pa.array([k for k, _ in parts], pa.int32()),
                                  **{c: pa.array([v[i].tobytes() for _, i in parts], pa.binary())
                                     for c, v in (("ids", ids), ("code", code), ("w", w[:, t:t + together]), ("s", s[:, t:t + together]))}})

    def subtree(t: pa.Table) -> pa.Table:
        tree, node = t.column("tree")[0].as_py(), t.column("node")[0].as_py()
        ids = np.frombuffer(b"".join(t.column("ids").to_pylist()), np.int64)
        order = np.argsort(ids)                         # sums do not depend on the order of arrival
        ids = ids[order]
        code, w, s = (np.frombuffer(b"".join(t.column(c).to_pylist()), d).reshape(len(order), -1)[order]
                      for c, d in (("code", np.uint8), ("w", float), ("s", float)))
        lists, value, own = bins.lists(code), np.zeros(len(ids)), []
        for k in range(w.shape[1]):
            v, gain = grow(bins, code, w[:, k], s[:, k], int(tops[tree + k]["depth"][node]), max_depth, lists)
            value += v
            own.append(gain.tolist())
        none = [None] * len(own)
        return pa.table({"id": pa.concat_arrays([pa.array(ids), pa.array(none, pa.int64())]),
                         "value": pa.concat_arrays([pa.array(value), pa.array(none, pa.float64())]),
                         "tree": pa.array([None] * len(ids) + [tree + k for k in range(len(own))], pa.int32()),
                         "gains": pa.array([None] * len(ids) + own, pa.list_(pa.float64()))})

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                code, total = _matrix(b.column("code"), np.uint8, p), np.zeros(b.num_rows)
                for t in tops:
                    node = descend(code, t)
                    total += np.where(t["kind"][node] == LEAF, t["value"][node], 0.0)
                yield _batch({"id": b.column("id"), "value": total})

    below = table.mapInArrow(local, "tree int, node int, ids binary, code binary, w binary, s binary") \
        .repartition(8 * cores, "tree", "node").groupBy("tree", "node").applyInArrow(subtree, "id bigint, value double, tree int, gains array<double>")
    below = stage(below, "forest-leaves")
    values = below.where(F.col("id").isNotNull()).select("id", "value")
    if any((t["kind"] == LEAF).any() for t in tops):
        values = values.union(table.mapInArrow(leaf, "id bigint, value double"))
    for r in below.where(F.col("id").isNull()).select("tree", F.posexplode("gains").alias("f", "g")).groupBy("tree", "f").agg(F.sum("g").alias("g")).collect():
        gains[r["tree"], r["f"]] += r["g"]
    total = gains.sum(1, keepdims=True)
    share = (gains / np.where(total > 0, total, 1)).sum(0)
    scores = values.groupBy("id").agg((F.sum("value") / trees + F.lit(float(mean))).alias("prediction"))
    scores = stage(points.join(scores, "id").select(features, "prediction"), "forest-scores")
    return Forest(scores, share / share.sum() if share.sum() > 0 else share, features)
