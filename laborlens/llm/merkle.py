"""Merkle manifest of a dataset: digest trees of groups under one root.

Leaves are digests of rows.  A group's leaves in order are cut into aligned
subtrees of ``height`` levels, each stored as one row: its nodes in van Emde
Boas order, a tree being its upper half of levels followed by the trees that
hang below it, and so on within each half.  The roots of these blocks are the
leaves of the next level of blocks, until one block is left; the groups'
roots form a tree of the same kind.  Construction and the siblings of a proof
use the same address arithmetic, and a block is all that a task ever holds.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .common import importable, lean, written

DIGEST = 32


# -------------------------------------------------------------- addresses
def tree_size(levels: int, fan: int) -> int:
    """Nodes of a full tree of so many levels."""
    return (fan ** levels - 1) // (fan - 1)


@lru_cache(maxsize=None)
def addresses(levels: int, fan: int) -> tuple[np.ndarray, ...]:
    """Per depth, the root's first, the places of its nodes in van Emde Boas
    order."""
    if levels == 1:
        return (np.zeros(1, np.int64),)
    upper = levels // 2
    lower = levels - upper
    top, bottom = addresses(upper, fan), addresses(lower, fan)
    below = tree_size(upper, fan) + np.arange(fan ** upper) * tree_size(lower, fan)
    return (*top, *((below[:, None] + b).reshape(-1) for b in bottom))


class Block:
    """An aligned subtree: digests in van Emde Boas order, of which each
    depth's first ``widths`` are there."""

    def __init__(self, count: int, levels: int, fan: int, nodes: bytearray | bytes | None = None):
        self.count, self.levels, self.fan = count, levels, fan
        self.at = [a.tolist() for a in addresses(levels, fan)]
        self.widths = [count]
        for _ in range(levels - 1):
            self.widths.append(-(-self.widths[-1] // fan))
        self.widths.reverse()                                     # by depth; a lone root above padding levels counts too
        self.nodes = bytearray(DIGEST * tree_size(levels, fan)) if nodes is None else nodes

    def get(self, depth: int, i: int) -> bytes:
        at = DIGEST * self.at[depth][i]
        return bytes(self.nodes[at:at + DIGEST])

    def put(self, depth: int, i: int, digest: bytes) -> None:
        at = DIGEST * self.at[depth][i]
        self.nodes[at:at + DIGEST] = digest

    def build(self, leaves: Sequence[bytes]) -> bytes:
        """Fill the block from its leaves; its root."""
        for i, d in enumerate(leaves):
            self.put(self.levels - 1, i, d)
        row = list(leaves)
        for depth in range(self.levels - 2, -1, -1):
            row = [join(row[i:i + self.fan]) for i in range(0, len(row), self.fan)]
            for i, d in enumerate(row):
                self.put(depth, i, d)
        return row[0]

    def path(self, i: int) -> list[tuple[int, bytes]]:
        """From leaf ``i`` up: its place in each run, and the siblings of the
        run one after another, left to right."""
        out = []
        for depth in range(self.levels - 1, 0, -1):
            first = i - i % self.fan
            run = range(first, min(first + self.fan, self.widths[depth]))
            out.append((i - first, b"".join(self.get(depth, j) for j in run if j != i)))
            i //= self.fan
        return out


def join(digests: Sequence[bytes]) -> bytes:
    """The digest of a run: of its members' hexadecimal texts, one after another."""
    return sha256("".join(d.hex() for d in digests).encode()).digest()


def pack(path: list[tuple[int, bytes]]) -> bytes:
    """A path as bytes: per level the place in the run, the number of siblings, the siblings."""
    return b"".join(bytes((place, len(sib) // DIGEST)) + sib for place, sib in path)


def unpack(raw: bytes) -> Iterator[tuple[int, bytes]]:
    at = 0
    while at < len(raw):
        place, n = raw[at], raw[at + 1]
        yield place, raw[at + 2:at + 2 + n * DIGEST]
        at += 2 + n * DIGEST


def fold(leaf: bytes, path: Sequence[tuple[int, bytes]]) -> bytes:
    """The root that ``leaf`` and the siblings of its path give."""
    d = leaf
    for place, sib in path:
        run = [sib[k:k + DIGEST] for k in range(0, len(sib), DIGEST)]
        d = join([*run[:place], d, *run[place:]])
    return d


def levels_for(count: int, fan: int) -> int:
    levels = 1
    while fan ** (levels - 1) < count:
        levels += 1
    return levels


# ------------------------------------------------------------------ leaves
def row_digest(cols: Sequence[str | Column]) -> Column:
    """The digest of a row: per column ``-`` if null, else its length in
    UTF-8 bytes, a colon and the value."""
    def part(c: str | Column) -> Column:
        v = (F.col(c) if isinstance(c, str) else c).cast("string")
        return F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
    return F.sha2(F.encode(F.concat(*[part(c) for c in cols]), "UTF-8"), 256)


def placed(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``pos``, 0-based in ``order`` within ``grp``.

    Rows are range-partitioned, with a number per row as the last key, so a
    group of any size, or of equal rows, spreads over tasks; a table of
    counts per group and partition gives the offsets."""
    n = shuffle_partitions(rows.sparkSession)
    s = rows.withColumn("tie", F.monotonically_increasing_id())
    s = s.repartitionByRange(n, "grp", *order, "tie").sortWithinPartitions("grp", *order, "tie").drop("tie")
    s = written(s.withColumn("part", F.spark_partition_id()).withColumn("nth", F.monotonically_increasing_id()), name)
    w = Window.partitionBy("grp").orderBy("part")
    parts = s.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("n"), F.min("nth").alias("least"))
    parts = parts.withColumn("before", F.sum("n").over(w) - F.col("n")).withColumn("total", F.sum("n").over(Window.partitionBy("grp")))
    return s.join(parts.drop("n"), ["grp", "part"]).withColumn("pos", F.col("before") + F.col("nth") - F.col("least")) \
        .drop("part", "nth", "before", "least")


# ------------------------------------------------------------ construction
BLOCKS = ("grp string, block bigint, total bigint, count int, levels int, root binary, nodes binary, "
          "payload array<struct<id:bigint,changed:binary>>")


def build_blocks(leaves: DataFrame, fan: int, height: int, payload: bool) -> DataFrame:
    """Blocks of leaves ``grp``, ``pos``, ``total`` (leaves of the group),
    ``digest`` and, for rows of the dataset, what proofs need: ``id`` and
    ``changed`` (another digest to be folded, or null)."""
    per = fan ** height

    def build(key: tuple, table: pa.Table) -> pa.Table:
        t = table.sort_by("pos")
        total = t.column("total")[0].as_py()
        digests = t.column("digest").to_pylist()
        # a block among others has its full height; the only one ends at its root
        levels = height + 1 if total > per else levels_for(len(digests), fan)
        b = Block(len(digests), levels, fan)
        root = b.build(digests)
        held = list(zip(t.column("id").to_pylist(), t.column("changed").to_pylist(), strict=True)) if payload else None
        return pa.table({
            "grp": [key[0].as_py()], "block": [key[1].as_py()], "total": [total],
            "count": pa.array([len(digests)], pa.int32()), "levels": pa.array([levels], pa.int32()),
            "root": pa.array([root], pa.binary()), "nodes": pa.array([bytes(b.nodes)], pa.binary()),
            "payload": pa.array([held and [{"id": i, "changed": c} for i, c in held]],
                                pa.list_(pa.struct([("id", pa.int64()), ("changed", pa.binary())])))})

    cols = ["grp", "pos", "total", "digest", *(["id", "changed"] if payload else [])]
    return leaves.select(*cols, F.expr(f"pos div {per}").alias("block")).groupBy("grp", "block").applyInArrow(lean(build), BLOCKS)


def build_tree(leaves: DataFrame, fan: int, height: int, name: str, payload: bool) -> tuple[list[DataFrame], DataFrame]:
    """All levels of blocks, and ``grp``, ``root`` of every group."""
    levels = [written(build_blocks(leaves, fan, height, payload), f"{name}-blocks")]
    tops = []
    while True:
        here = levels[-1].select("grp", "block", "total", "root")
        per = fan ** height
        tops.append(here.where(F.col("total") <= per).select("grp", "root"))
        up = here.where(F.col("total") > per)
        if up.isEmpty():
            break
        up = up.select("grp", F.col("block").alias("pos"), F.ceil(F.col("total") / per).cast("bigint").alias("total"), F.col("root").alias("digest"))
        levels.append(written(build_blocks(up, fan, height, False), f"{name}-blocks"))
    roots = tops[0]
    for t in tops[1:]:
        roots = roots.union(t)
    return levels, roots


# ----------------------------------------------------------------- proofs
PATHS = "grp string, block bigint, above binary, subroot binary, root binary"


def descend(levels: list[DataFrame], above: DataFrame, fan: int, height: int) -> DataFrame:
    """Blocks of rows joined with the path above each: ``above`` has one for
    every group's root (``grp``, ``above``, ``subroot``, ``root``)."""
    def paths(key: tuple, table: pa.Table) -> pa.Table:
        r = table.to_pylist()[0]
        b = Block(r["count"], r["levels"], fan, r["nodes"])
        first = r["block"] * fan ** (r["levels"] - 1)
        return pa.table({
            "grp": [r["grp"]] * b.count, "block": pa.array(range(first, first + b.count), pa.int64()),
            "above": pa.array([pack(b.path(i)) + r["above"] for i in range(b.count)], pa.binary()),
            "subroot": pa.array([r["subroot"]] * b.count, pa.binary()), "root": pa.array([r["root"]] * b.count, pa.binary())})

    known = None
    for i, level in reversed(list(enumerate(levels))):
        # a group's only block hangs on the group's root; the others on blocks of the level above
        top = above.withColumn("block", F.lit(0).cast("bigint"))
        here = top.join(level.where(F.col("total") <= fan ** height).select("grp"), "grp", "left_semi").select("grp", "block", "above", "subroot", "root")
        here = here if known is None else here.union(known)
        joined = level.drop("root").join(here, ["grp", "block"])
        if i == 0:
            return joined
        known = written(joined.groupBy("grp", "block").applyInArrow(lean(paths), PATHS), "paths")
    raise ValueError("no level")


def manifest(rows: DataFrame, digest: Column, changed: Column, id_col: str = "doc_id", group_col: str = "source",
             fan: int = 3, height: int = 7) -> DataFrame:
    """Per row: ``id_col``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``,
    ``folded_root`` and ``verified``, all digests in lowercase hexadecimal.

    ``digest`` is a row's leaf; leaves ascend by id within their group, and
    of several nodes every ``fan`` consecutive ones become one.  The groups'
    subroots, the null group first and the others by their UTF-8 bytes, are
    the leaves of the tree above.  A proof is the siblings from the leaf up;
    ``folded_root`` is what they give with ``changed`` (with ``digest`` where
    it is null), and ``verified`` says whether that is the root.

    A null id comes first; rows with equal ids are ordered by their leaf,
    equal rows have equal leaves and are rows of their own.  A lone leaf is
    its subroot and a lone subroot the root, and the proof of a lone row is
    empty.  An empty table gives no rows.  Other columns are ignored.
    """
    importable(rows.sparkSession)
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    leaves = rows.select(group.alias("grp"), F.col(id_col).cast("bigint").alias("id"),
                         F.unhex(digest).alias("digest"), F.unhex(changed).alias("changed"))
    # equal to the leaf: nothing to keep.  Written, as cutting ranges reads its input twice
    leaves = written(leaves.withColumn("changed", F.when(F.col("changed") != F.col("digest"), F.col("changed"))), "leaf-rows")
    levels, subroots = build_tree(placed(leaves, ["id", "digest"], "leaves"), fan, height, "rows", True)
    subroots = written(subroots, "subroots")
    upper = placed(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("root").alias("digest")), ["name"], "groups")
    upper = written(upper, "groups")
    upper_levels, roots = build_tree(upper, fan, height, "groups", False)

    lone = roots.select("grp", F.lit(b"").alias("above"), F.lit(b"").alias("subroot"), "root")
    tops = descend(upper_levels, lone, fan, height)

    def group_paths(key: tuple, table: pa.Table) -> pa.Table:
        r = table.to_pylist()[0]
        b = Block(r["count"], r["levels"], fan, r["nodes"])
        first = r["block"] * fan ** height
        return pa.table({
            "pos": pa.array(range(first, first + b.count), pa.int64()),
            "above": pa.array([pack(b.path(i)) + r["above"] for i in range(b.count)], pa.binary()),
            "root": pa.array([r["root"]] * b.count, pa.binary())})

    named = tops.groupBy("grp", "block").applyInArrow(lean(group_paths), "pos bigint, above binary, root binary")
    above = upper.select("pos", F.col("name").alias("grp"), F.col("digest").alias("subroot")).join(named, "pos")
    blocks = descend(levels, written(above.select("grp", "above", "subroot", "root"), "above"), fan, height)

    def prove(key: tuple, table: pa.Table) -> pa.Table:
        r = table.to_pylist()[0]
        b = Block(r["count"], r["levels"], fan, r["nodes"])
        higher = list(unpack(r["above"]))
        last = b.levels - 1
        out: dict[str, list] = {c: [] for c in ("id", "leaf", "proof", "folded")}
        for i, x in enumerate(r["payload"]):
            path = b.path(i) + higher
            leaf = b.get(last, i)
            out["id"].append(x["id"])
            out["leaf"].append(leaf.hex())
            out["proof"].append(sha256("".join(s.hex() for _, s in path).encode()).hexdigest())
            out["folded"].append(fold(leaf if x["changed"] is None else x["changed"], path).hex())
        return pa.table({"id": pa.array(out["id"], pa.int64()), "leaf": out["leaf"], "subroot": [r["subroot"].hex()] * b.count,
                         "root": [r["root"].hex()] * b.count, "proof_sha256": out["proof"], "folded_root": out["folded"]})

    proved = blocks.groupBy("grp", "block").applyInArrow(
        lean(prove), "id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return proved.withColumnRenamed("id", id_col).withColumn("verified", F.col("folded_root") == F.col("root"))
