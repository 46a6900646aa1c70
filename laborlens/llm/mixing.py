"""Mixing sources to target weights, by min-cost flow over membership patterns.

Documents are summed up by the set of sources that they belong to.  Every
source gets a quota of words from its weight, and the words of each pattern
are routed to its sources' quotas: a min-cost flow in which the k-th copy of
a word costs k, so no word is repeated while another unused one could serve.
Patterns that share no source never meet, so each connected set of patterns
is one small task.  Within a pattern whole documents are then taken in a
seeded order until the routed words are reached.
"""
from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.quantiles import rank_within
from .common import importable, lean, whole_text, written
from .components import components

DIGIT = 3          # hexadecimal digits that one round of a cut resolves
SMALL = 10_000     # rows of a table that may be broadcast; rows of a key that one window may order


def word_count(text: str | Column) -> Column:
    """The number of ``[^\\x20\\x09-\\x0D]+`` in a text (a null one has
    none), without an array of the words."""
    marks = F.regexp_replace(whole_text(text), r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.regexp_replace(marks, r"[\x20\x09-\x0D]+", "")).cast("bigint")


def targets(sources: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """``source``, ``size``, ``weight``, ``target`` of a table ``source``,
    ``size``.  Sources in order take the weights in turn and share all words
    by them; what exceeds ``most`` times a source's size is shared again
    among the others, until nothing does.

    Each round reads one row; the set of full sources only grows.
    """
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    ranked = rank_within(sources, [], "source")
    s = written(ranked.select("source", "size", F.element_at(cycle, (F.col("_rank") % len(weights) + 1).cast("int")).alias("weight")), "sources")
    full, level = -1, 0.0
    while True:
        over = F.col("size") * most < F.lit(level) * F.col("weight")
        n, words, held, open_weight = s.agg(
            F.count_if(over), F.sum("size"), F.sum(F.when(over, F.col("size") * most)),
            F.sum(F.when(~over, F.col("weight")))).first()
        if n == full or not open_weight:
            break
        full, level = n, ((words or 0) - (held or 0)) / open_weight
    return s.withColumn("target", F.when(over, (F.col("size") * most).cast("double")).otherwise(F.lit(level) * F.col("weight")))


# -------------------------------------------------------------------- flow
def route(words: Sequence[int], members: Sequence[Sequence[int]], quotas: Sequence[int], most: int) -> list[dict[int, int]]:
    """Per pattern the words that each of its sources gets, of the cheapest
    largest flow: pattern p offers ``words[p]`` words up to ``most`` times,
    the k-th copy at cost k, and source s takes ``quotas[s]``.

    Costs lie on the offers alone, so a cheapest path is any path from the
    cheapest offer left: all of the k-th copies are routed as far as they
    go, by augmenting along shortest paths level by level, before the next.
    """
    flow = [dict.fromkeys(m, 0) for m in members]
    users: list[list[int]] = [[] for _ in quotas]
    for p, m in enumerate(members):
        for s in m:
            users[s].append(p)
    left, sent = list(quotas), [0] * len(words)
    for copy in range(1, most + 1):
        while True:
            # breadth first from the offers; nodes are patterns, and sources as -1 - s
            depth = {p: 0 for p in range(len(words)) if sent[p] < copy * words[p]}
            queue, end = deque(depth), None
            while queue:
                v = queue.popleft()
                if end is not None and depth[v] >= end:
                    break
                if v >= 0:
                    near = [-1 - s for s in members[v]]
                else:
                    near = [p for p in users[-1 - v] if flow[p][-1 - v]]
                    if left[-1 - v]:
                        end = depth[v]
                        continue
                for w in near:
                    if w not in depth:
                        depth[w] = depth[v] + 1
                        queue.append(w)
            if end is None:
                break
            at: dict[int, int] = {}
            for start in [p for p, d in depth.items() if d == 0 and p >= 0]:
                while sent[start] < copy * words[start]:
                    path = [start]
                    while path:
                        v = path[-1]
                        if v < 0 and left[-1 - v]:
                            break
                        arcs = members[v] if v >= 0 else users[-1 - v]
                        i = at.get(v, 0)
                        while i < len(arcs):
                            w = -1 - arcs[i] if v >= 0 else arcs[i]
                            if depth.get(w) == depth[v] + 1 and (v >= 0 or flow[w][-1 - v]):
                                break
                            i += 1
                        at[v] = i
                        if i < len(arcs):
                            path.append(w)
                        else:
                            path.pop()
                            if path:
                                at[path[-1]] += 1
                    if not path:
                        break
                    push = min(copy * words[start] - sent[start], left[-1 - path[-1]])
                    for v, w in zip(path[1::2], path[2::2], strict=False):
                        push = min(push, flow[w][-1 - v])
                    for v, w in zip(path, path[1:], strict=False):
                        if v >= 0:
                            flow[v][-1 - w] += push
                        else:
                            flow[w][-1 - v] -= push
                    sent[start] += push
                    left[-1 - path[-1]] -= push
    return flow


def flows(patterns: DataFrame, goals: DataFrame, most: int, max_patterns: int = 200_000) -> DataFrame:
    """``pattern``, ``source``, ``words``: what each source gets of a pattern.

    ``patterns`` (pattern, words) are summed rows, ``goals`` the sources'
    targets.  A task holds one connected set of patterns, which is their
    number and not that of documents; more than ``max_patterns`` of them in
    one set is an error."""
    spark = patterns.sparkSession
    links = patterns.where(F.size("pattern") > 1).select(
        F.explode(F.slice("pattern", 2, F.size("pattern"))).alias("a"), F.element_at("pattern", 1).alias("b"))
    root = components(links).withColumnRenamed("node", "source")
    quota = goals.join(root, "source", "left").select(
        "source", F.coalesce("root", "source").alias("root"), F.round("target").cast("bigint").alias("quota"))
    edges = patterns.where(F.size("pattern") > 0).select("pattern", "words", F.explode("pattern").alias("source"))
    edges = edges.join(quota, "source")

    def solve(table: pa.Table) -> pa.Table:
        names = sorted(set(table.column("source").to_pylist()))
        number = {s: i for i, s in enumerate(names)}
        offers, quotas = {}, [0] * len(names)
        for r in table.select(["pattern", "words", "source", "quota"]).to_pylist():
            offers[tuple(r["pattern"])] = r["words"]
            quotas[number[r["source"]]] = r["quota"]
        if len(offers) > max_patterns:
            raise ValueError(f"{len(offers)} patterns are connected, more than {max_patterns}")
        keys = sorted(offers)
        got = route([offers[k] for k in keys], [[number[s] for s in k] for k in keys], quotas, most)
        out = [(list(k), names[s], n) for k, f in zip(keys, got, strict=True) for s, n in f.items()]
        return pa.table({"pattern": pa.array([o[0] for o in out], pa.list_(pa.string())), "source": pa.array([o[1] for o in out], pa.string()),
                         "words": pa.array([o[2] for o in out], pa.int64())})

    importable(spark)
    return edges.groupBy("root").applyInArrow(lean(solve), "pattern array<string>, source string, words bigint")


# --------------------------------------------------------------- selection
def _by_pattern(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Join a row per pattern; broadcast where their number proves it small."""
    return rows.join(F.broadcast(table) if table.limit(SMALL + 1).count() <= SMALL else table, "pattern")


def last_fitting(rows: DataFrame, need: DataFrame) -> DataFrame:
    """Per pattern of ``need`` (pattern, need): ``upto``, the last key of the
    longest run of ``rows`` (pattern, key, size) in key order whose sizes sum
    up to ``need`` at most (null: none), and ``got``, that sum.

    Keys are hexadecimal and told apart by rows.  A round sums the sizes by
    the key's next digits, and only the bucket in which the sum passes the
    need is looked into further, until it holds few enough rows to order.
    """
    state = written(need.select("pattern", "need", F.lit("").alias("prefix"), F.lit(0).cast("bigint").alias("got"),
                                F.lit(None).cast("string").alias("upto")), "cut")
    depth, inside = 0, rows.groupBy("pattern").count().agg(F.max("count")).first()[0] or 0
    while inside:
        whole = inside <= SMALL
        open_ = state.where(F.col("prefix").isNotNull())
        held = _by_pattern(rows, open_).where(F.col("key").startswith(F.col("prefix")))
        digit = F.col("key") if whole else F.substring("key", depth + 1, DIGIT)
        sums = held.groupBy("pattern", digit.alias("digit")).agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"), F.max("key").alias("top"))
        run = F.sum("size").over(Window.partitionBy("pattern").orderBy("digit"))
        sums = sums.withColumn("run", run).join(open_.select("pattern", "need", "got", "prefix"), "pattern")
        fits = F.col("got") + F.col("run") <= F.col("need")
        step = sums.groupBy("pattern").agg(
            F.max(F.when(fits, F.col("run"))).alias("more"), F.max(F.when(fits, F.col("top"))).alias("last"),
            F.min(F.when(~fits, F.concat("prefix", "digit"))).alias("cut"), F.min_by("n", F.when(~fits, F.col("digit"))).alias("n"))
        state = written(state.drop("n").join(step, "pattern", "left").select(
            "pattern", "need", (F.lit(None).cast("string") if whole else F.col("cut")).alias("prefix"),
            (F.col("got") + F.coalesce("more", F.lit(0))).alias("got"), F.coalesce("last", "upto").alias("upto"), "n"), "cut")
        inside = 0 if whole else state.where(F.col("prefix").isNotNull()).agg(F.max("n")).first()[0] or 0
        depth += DIGIT
    return state.select("pattern", "got", "upto")


def mix_sources(docs: DataFrame, members: Column, size: Column, id_col: str = "doc_id", weights: Sequence[int] = (1, 2, 3),
                most: int = 3, seed: int = 17) -> DataFrame:
    """Per document: ``id_col``, ``size``, ``taken`` (words that the mix takes,
    copies counted) and ``shares``, an array of what its membership pattern
    means: each source with its ``source_size``, ``target`` and the ``words``
    that the flow routes to it from all documents of the pattern.

    ``members`` is the array of a document's sources.  Sources in code point
    order take ``weights`` in turn, a null source last; all words are shared
    by weight, no target above ``most`` times its source's size.  A document
    is taken whole, up to ``most`` times; the documents of a pattern that get
    one copy more than the others come first in an order seeded by ``seed``
    and the id.  Where the next one would exceed the routed words, shorter
    ones fill the rest in a second run, and one more document is taken or not,
    whichever ends nearer.

    A null array counts as the null source; an empty one has no source, and
    nothing is taken (``shares`` is empty).  Null sizes are zero.  Rows with
    repeated or null ids are documents of their own, ordered by where they
    lie in the table; all else depends on ids and sizes alone, so reruns
    agree.  An empty table gives no rows.  Other columns are ignored.
    """
    name = lambda x: F.coalesce(F.concat(F.lit("0"), x.cast("string")), F.lit("1"))  # noqa: E731  a null source comes last
    pattern = F.coalesce(F.array_sort(F.array_distinct(F.transform(members, name))), F.array(F.lit("1")))
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(size.cast("bigint"), F.lit(0)).alias("size"), pattern.alias("pattern"))
    order = F.substring(F.md5(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("-")), F.lit(f":{seed}"))), 1, 18)
    row = F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0")
    rows = written(base.withColumn("key", F.concat(order, row)), "mix-rows")

    patterns = written(rows.groupBy("pattern").agg(F.sum("size").alias("words")), "patterns")
    sized = patterns.select(F.explode("pattern").alias("source"), "words").groupBy("source").agg(F.sum("words").alias("size"))
    goals = written(targets(sized, weights, most), "targets")
    routed = written(flows(patterns, goals, most), "flows")
    shares = routed.join(goals.select("source", F.col("size").alias("source_size"), "target"), "source").groupBy("pattern").agg(
        F.sum("words").alias("flow"),
        F.array_sort(F.collect_list(F.struct("source", "source_size", "target", "words"))).alias("shares"))
    copies = F.coalesce(F.expr("flow div nullif(words, 0)"), F.lit(0)).cast("bigint")
    plan = patterns.join(shares, "pattern").select("pattern", "words", "shares", copies.alias("copies"),
                                                   (F.col("flow") - copies * F.col("words")).alias("need"))
    plan = written(plan, "plan")

    # one copy more: a run in seeded order, a second one of what still fits, then the nearest
    first = last_fitting(rows.where("size > 0"), plan.where("need > 0").select("pattern", "need"))
    plan = written(plan.join(first, "pattern", "left").select(
        "pattern", "shares", "copies", F.col("upto").alias("upto1"), (F.col("need") - F.coalesce("got", F.lit(0))).alias("left1")), "plan")
    open_ = plan.where("left1 > 0").select("pattern", F.coalesce("upto1", F.lit("")).alias("upto1"), "left1")
    rest = written(_by_pattern(rows.where("size > 0"), open_).where("key > upto1"), "rest")
    second = last_fitting(rest.where("size <= left1").select("pattern", "key", "size"), open_.select("pattern", F.col("left1").alias("need")))
    open_ = written(open_.join(second, "pattern").select("pattern", F.col("upto").alias("upto2"), (F.col("left1") - F.col("got")).alias("left2")), "open")
    free = _by_pattern(rest, open_).where("size > left1 OR upto2 IS NULL OR key > upto2")
    gap = F.abs(F.col("size") - F.col("left2"))
    nearest = free.where(gap < F.col("left2")).groupBy("pattern").agg(F.min_by("key", F.struct(gap, "key")).alias("extra"))
    plan = written(plan.join(open_, "pattern", "left").join(nearest, "pattern", "left"), "plan")

    more = F.coalesce(F.col("key") <= F.col("upto1"), F.lit(False)) \
        | F.coalesce((F.col("size") <= F.col("left1")) & (F.col("key") <= F.col("upto2")), F.lit(False)) \
        | F.coalesce(F.col("key") == F.col("extra"), F.lit(False))
    small = plan.limit(SMALL + 1).count() <= SMALL
    out = rows.join(F.broadcast(plan) if small else plan, "pattern", "left")
    shown = F.transform(F.coalesce("shares", F.array().cast("array<struct<source:string,source_size:bigint,target:double,words:bigint>>")),
                        lambda x: F.struct(F.when(x["source"] != "1", F.substring(x["source"], 2, 1 << 30)).alias("source"),
                                           x["source_size"].alias("source_size"), x["target"].alias("target"), x["words"].alias("words")))
    return out.select(F.col("id").alias(id_col), "size", shown.alias("shares"),
                      (F.col("size") * (F.coalesce("copies", F.lit(0)) + more.cast("bigint"))).alias("taken"))
