"""Exact order statistics without putting a group into one task.

``percentile``/``median`` aggregates keep every distinct value of a group in
one buffer, and a window ordered over a whole group runs in one task; both
break when one group holds a third of the rows.  Quantiles are selected
instead: rows are counted in buckets, and only the buckets that can hold a
wanted position are counted by value (``quantile_cont``: two positions,
interpolated).

Where every value's position is asked for, rows are first counted per
(group, value), which combines before the shuffle and dissolves ties, so
a value in 90 % of the rows is one row afterwards.  The distinct values are
then range-partitioned on (group, value): no two of them are equal, so any
group is spread evenly over many tasks.  Per (group, partition) the counts
are summed; a running sum over that small table gives each block's offset,
and the position of every value follows.
``approx=True`` switches to ``percentile_approx`` with bounded memory.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root, shuffle_partitions


def _blocks_offsets(blocks: DataFrame, keys: Sequence[str], size_col: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy("_p") if keys else Window.orderBy("_p")
    wall = Window.partitionBy(*keys) if keys else Window.partitionBy()
    return (blocks
            .withColumn("_off", F.coalesce(F.sum(size_col).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("_n", F.sum(size_col).over(wall)))


def sorted_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-partitioned, sorted rows with partition id ``_p`` and row id
    ``_i``.  ``order`` should tell rows of a group apart: equal rows can't
    be split over partitions."""
    n = partitions or shuffle_partitions(df.sparkSession)
    s = df.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)
    s = s.withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id())
    # Range bounds are sampled with a seed tied to the RDD id, so two
    # executions of this plan can cut partitions differently.  The rows and
    # the per-block sums must see the same cut: a reliable checkpoint in the
    # shared folder fixes it once (and survives executor loss).
    checkpoint_root(df.sparkSession)
    return s.checkpoint(eager=True)


def value_counts(df: DataFrame, keys: Sequence[str], value: str, partitions: int | None = None) -> DataFrame:
    """A row per group and distinct non-null value: ``_c`` rows have it,
    ``_cum`` rows have it or a smaller one, ``_n`` rows are in the group."""
    keys = list(keys)
    d = df.select(*keys, value).where(F.col(value).isNotNull())
    for k in keys:
        d = d.where(F.col(k).isNotNull())
    return running_sum(d.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c")), keys, [value], "_c", partitions)


def rank_within(df: DataFrame, keys: Sequence[str], value: str, partitions: int | None = None) -> DataFrame:
    """Rows with non-null keys and ``value``, plus ``_rank`` (0-based position
    in ascending ``value`` order inside the group) and ``_n`` (group size).
    Ties are told apart by a hash of the row, so they spread over tasks."""
    keys = list(keys)
    d = df.where(F.col(value).isNotNull())
    for k in keys:
        d = d.where(F.col(k).isNotNull())
    s = sorted_blocks(d.withColumn("_t", F.xxhash64(*df.columns, F.monotonically_increasing_id())), keys, [value, "_t"], partitions)
    blocks = s.groupBy(*keys, "_p").agg(F.count(F.lit(1)).alias("_c"), F.min("_i").alias("_m"))
    blocks = _blocks_offsets(blocks, keys, "_c").drop("_c")
    return (s.join(blocks, [*keys, "_p"])
            .withColumn("_rank", F.col("_off") + F.col("_i") - F.col("_m"))
            .drop("_p", "_i", "_m", "_off", "_t"))


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], weight: str,
                partitions: int | None = None) -> DataFrame:
    """Adds ``_cum``, the sum of ``weight`` over rows up to and including this
    one in ``order`` within ``keys``, and ``_n``, the sum over the group.  The
    per-row part is a window per (group, range partition); block totals are
    carried by the offsets.  Rows that are equal in ``keys`` and ``order``
    stay in one partition, so count them first."""
    keys = list(keys)
    s0 = sorted_blocks(df, keys, order, partitions)
    w = Window.partitionBy(*keys, "_p").orderBy("_i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = s0.withColumn("_local", F.sum(weight).over(w))
    blocks = s0.groupBy(*keys, "_p").agg(F.sum(weight).alias("_w"))
    blocks = _blocks_offsets(blocks, keys, "_w").drop("_w")
    return (s.join(blocks, [*keys, "_p"])
            .withColumn("_cum", F.col("_off") + F.col("_local"))
            .drop("_p", "_i", "_local", "_off"))


def quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float],
              approx: bool = False, accuracy: int = 10000, extra: Mapping[str, Column] | None = None,
              brackets: int = 50_000, few: int = 20_000) -> DataFrame:
    """One row per group: ``keys`` + one column per name in ``probs`` (and
    per aggregate in ``extra``, of the rows that count).  Rows with a null
    key, a null value or NaN don't count.

    Exact: linear interpolation between the order statistics at
    floor/ceil((n-1) q), found by selection in two passes.  The first
    brackets every quantile by a mergeable sketch of relative error
    1 / ``brackets`` (``percentile_approx``), four errors and at least four
    rows to either side.  The second counts: rows between two brackets are one bucket of their group,
    only rows inside a bracket are counted by value.  Counts combine before
    their shuffle, and what a group's running sum orders is the brackets'
    values, some 8 / ``brackets`` of its rows per quantile; rows are never
    sorted.  The brackets are one broadcast row without keys; with keys they
    are broadcast where at most ``few`` groups have them, otherwise joined.
    Approximate: ``percentile_approx`` alone."""
    keys, extra = list(keys), dict(extra or {})
    cond = F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    d = df.where(cond)
    more = [c.alias(name) for name, c in extra.items()]
    group = (lambda x: x.groupBy(*keys)) if keys else (lambda x: x)
    if approx:
        return group(d).agg(*more, *[F.percentile_approx(value, q, accuracy).cast("double").alias(name) for name, q in probs.items()])

    v = F.col(value).cast("double")
    # a bracket reaches four errors of the sketch to either side, and four rows where those are more
    reach = [4.0 * 10 ** j / brackets for j in range(12) if 4.0 * 10 ** j < brackets] + [1.0]
    edges = [min(1.0, max(0.0, q + side * m)) for q in probs.values() for side in (-1, 1) for m in reach]
    first = group(d).agg(*more, F.count(F.lit(1)).alias("_n"), F.percentile_approx(v, edges, brackets).alias("_e"))
    wide = F.lit(len(reach) - 1)
    for j in range(len(reach) - 2, -1, -1):
        wide = F.when(F.col("_n") * reach[j] >= 4.0, F.lit(j)).otherwise(wide)
    ends = range(2 * len(probs))
    first = first.select(*keys, *extra, "_n", *[F.get("_e", wide + i * len(reach)).alias(f"_e{i}") for i in ends])
    small = True
    if keys:
        # one job here; the rows found stand in for it in the plan
        got = first.limit(few + 1).collect()
        small = len(got) <= few
        if small:
            first = df.sparkSession.createDataFrame(got, first.schema)
    look = F.broadcast(first) if small else first
    d = d.select(*keys, v.alias("_v"))
    j = d.join(look, keys) if keys else d.crossJoin(look)
    pairs = [(F.col(f"_e{i}"), F.col(f"_e{i + 1}")) for i in range(0, len(ends), 2)]
    inside = reduce(lambda a, b: a | b, [(F.col("_v") >= lo) & (F.col("_v") <= hi) for lo, hi in pairs])
    # a row outside all brackets stands right behind the last one that ends below it
    behind = F.greatest(F.lit(float("-inf")), *[F.when(hi < F.col("_v"), hi) for _, hi in pairs])
    own = [*keys, *extra, "_n"]
    c = j.groupBy(*own, F.when(inside, F.col("_v")).otherwise(behind).alias("_at"), (~inside).alias("_gap")).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*keys).orderBy("_at", "_gap") if keys else Window.orderBy("_at", "_gap")
    c = c.withColumn("_cum", F.sum("_c").over(w))
    h = {name: (F.col("_n") - 1).cast("double") * F.lit(float(q)) for name, q in probs.items()}

    def holds(position: Column) -> Column:
        return (F.col("_cum") - F.col("_c") <= position) & (position < F.col("_cum"))

    lost = F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double")
    value_at = F.when(F.col("_gap"), lost).otherwise(F.col("_at"))
    picks = [F.max(F.when(holds(f(x)), value_at)).alias(f"_{end}_{name}") for name, x in h.items() for end, f in (("lo", F.floor), ("hi", F.ceil))]
    kept = [F.first(x).alias(x) for x in [*extra, "_n"]]
    g = group(c).agg(*kept, *picks)
    between = [(F.col(f"_lo_{name}") + (x - F.floor(x)) * (F.col(f"_hi_{name}") - F.col(f"_lo_{name}"))).alias(name) for name, x in h.items()]
    return g.select(*keys, *extra, *between)


def positions(df: DataFrame, value: str, keys: Sequence[str] = (), chunk: int = 65_536) -> DataFrame:
    """Every non-null value once per row that has it, with its 1-based
    ``position`` in sorted order and the group's size ``_n``.  A value with
    many rows is cut into chunks that spread over tasks before they unfold."""
    v = value_counts(df, keys, value)
    first = F.col("_cum") - F.col("_c") + 1
    v = v.withColumn("_from", F.explode(F.sequence(first, F.col("_cum"), F.lit(chunk).cast("bigint"))))
    v = v.repartition(shuffle_partitions(df.sparkSession))
    upto = F.least(F.col("_from") + chunk - 1, F.col("_cum"))
    return v.select(*keys, value, "_n", F.explode(F.sequence("_from", upto)).alias("position"))


def ecdf(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Every non-null value with its position i/n in sorted order."""
    r = positions(df, value, keys)
    return r.select(*keys, F.col(value), (F.col("position") / F.col("_n")).alias("ecdf"), "position")


def percentile_of_score(market: DataFrame, value: str, scores: DataFrame, score_col: str,
                        id_cols: Sequence[str]) -> DataFrame:
    """For each score row, 100 * (#market rows with value <= score) /
    (#market rows, nulls included).  Distinct values of both sides are put in
    one order; any number of scores is handled without a broadcast."""
    total = market.agg(F.count(F.lit(1)).alias("_total"))
    m = market.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_w"))
    s = scores.where(F.col(score_col).isNotNull()).select(F.col(score_col).cast("double").alias("_v"), *id_cols)
    both = m.unionByName(s.select("_v").distinct().withColumn("_w", F.lit(0).cast("bigint")))
    below = running_sum(both.groupBy("_v").agg(F.sum("_w").alias("_w")), [], ["_v"], "_w").select("_v", "_cum")
    return (s.join(below, "_v").crossJoin(F.broadcast(total))
            .select(*id_cols, F.col("_v").alias(score_col), F.col("_cum").alias("n_le"),
                    (F.col("_cum") / F.col("_total") * 100.0).alias("percentile")))
