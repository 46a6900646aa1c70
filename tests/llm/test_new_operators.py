import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from laborlens.llm import hard_negatives, merkle, mixing, queries

from .conftest import SF


def oracle(name, tables):
    """The rows of a query's SQL over tables of the smallest test data."""
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = con.execute(queries.ORACLES[name])
    return [c[0] for c in got.description], got.fetchall()


# ---------------------------------------------------------- hard negatives
def brute_negatives(rows, anchors):
    """rows: (id, vector, label) of rows that take part; anchors: their positions."""
    q = [None if v is None else [int(np.floor(256 * float(x))) for x in v] for _, v, _ in rows]
    last = 1 << 70
    out = []
    for a in anchors:
        score = {j: sum(x * y for x, y in zip(q[a], q[j], strict=True)) for j in range(len(rows)) if j != a and len(q[j]) == len(q[a])}
        key = lambda j: (-score[j], last if rows[j][0] is None else rows[j][0])  # noqa: B023, E731
        for p in sorted((j for j in score if rows[j][2] == rows[a][2]), key=key)[:5]:
            inside = [j for j in score if rows[j][2] != rows[a][2] and 50 * score[p] <= 100 * score[j] <= 95 * score[p]]
            out += [(rows[a][0], rows[p][0], k + 1, rows[j][0], score[p], score[j]) for k, j in enumerate(sorted(inside, key=key)[:3])]
    return out


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 0, 2), (0, 4, 3), (65, 33, 129), (130, 64, 70)])
def test_strassen_is_exact(shape):
    rng = np.random.default_rng(3)
    m, k, n = shape
    for size in (1 << 9, 1 << 30):
        a, b = rng.integers(-size, size, (m, k)), rng.integers(-size, size, (k, n))
        for leaf in (1, 8, 32):
            assert (hard_negatives.strassen(a, b, leaf) == a @ b).all()


def test_hard_negatives_query(spark, table, same):
    names, want = oracle("op13_hard_negatives", ["embeddings"])
    got = queries.op13_hard_negatives(spark, SF)
    assert want and dict(got.dtypes)["rank"] == "int"
    same(got, want, *names)


def test_hard_negatives_edges(spark, same):
    rng = np.random.default_rng(5)
    vec = lambda: [float(x) for x in rng.normal(size=7) / 2]
    twin, third = vec(), vec()
    rows = [(i, third if i % 3 == 0 else vec(), int(rng.integers(0, 3))) for i in range(300)]
    rows += [(300, twin, 1), (300, twin, 1), (300, twin, 2), (None, third, 0), (None, twin, 1), (350, [0.0] * 7, 2), (400, [], 0), (401, [], 1), (402, [], 0)]
    rows += [(450, [1.0, 2.0], 0), (451, [1.0, 2.5], 0), (452, [1.0, 1.5], 1), (500, [-1.0] * 7, 3), (501, [1.0] * 7, 3)]
    out = [(50, None, 1), (150, [None] * 7, 1), (100, [float("nan")] * 7, 1), (200, [float("inf")] * 7, 0), (250, twin, None), (250, [1e300] * 7, 0)]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows + out], "vec_id bigint, embedding array<double>, label int, row string, id int, grp int")
    want = brute_negatives(rows, [j for j, r in enumerate(rows) if r[0] is not None and r[0] % 50 == 0])
    for sizes in ({}, {"block": 4, "slab_rows": 37, "strip": 16}):
        same(hard_negatives.mine(df.repartition(7), fiftieth(), **sizes), want)
    assert hard_negatives.mine(df.where("false"), fiftieth()).count() == 0
    assert hard_negatives.mine(df.where("vec_id = 1"), fiftieth()).count() == 0


def fiftieth():
    return F.col("vec_id") % 50 == 0


# ----------------------------------------------------------------- mixing
def largest_flow(words, members, quotas, copies):
    """By the smallest cut: patterns on the offers' side need all their sources cut."""
    best = None
    for mask in range(1 << len(words)):
        kept = [p for p in range(len(words)) if mask >> p & 1]
        cut = sum(copies * w for p, w in enumerate(words) if not mask >> p & 1)
        cut += sum(quotas[s] for s in {s for p in kept for s in members[p]})
        best = cut if best is None else min(best, cut)
    return best


def test_route_is_the_cheapest_largest_flow():
    rng = random.Random(11)
    for _ in range(300):
        n = rng.randint(1, 5)
        members = [sorted(rng.sample(range(n), rng.randint(1, n))) for _ in range(rng.randint(1, 7))]
        words = [rng.choice([0, rng.randint(1, 9), rng.randint(1, 90)]) for _ in members]
        quotas = [rng.choice([0, rng.randint(1, 150)]) for _ in range(n)]
        flow = mixing.route(words, members, quotas, 3)
        sent = [sum(f.values()) for f in flow]
        assert all(set(f) == set(m) and min(f.values()) >= 0 for f, m in zip(flow, members, strict=True))
        assert all(sum(f.get(s, 0) for f in flow) <= q for s, q in enumerate(quotas))
        # cheapest with convex costs: the words of at most k copies are a largest flow for every k
        for k in (1, 2, 3):
            assert sum(min(x, k * w) for x, w in zip(sent, words, strict=True)) == largest_flow(words, members, quotas, k)


def brute_fill(rows, need):
    """rows: (key, size) sorted; the positions taken once more."""
    live = [i for i, r in enumerate(rows) if r[1] > 0]

    def run(at, room):
        got, total = [], 0
        for i in at:
            if total + rows[i][1] > room:
                break
            got.append(i)
            total += rows[i][1]
        return got, room - total

    one, left = run(live, need)
    rest = [i for i in live if i not in one]
    two, left = run([i for i in rest if rows[i][1] <= left], left)
    near = [(abs(rows[i][1] - left), rows[i][0], i) for i in rest if i not in two]
    last = [min(near)[2]] if left and near and min(near)[0] < left else []
    return {*one, *two, *last}


@pytest.mark.parametrize("few", [10_000, 3])
def test_mixing_edges(spark, monkeypatch, few):
    monkeypatch.setattr(mixing, "SMALL", few)     # with 3, cuts go through several digits and joins aren't broadcast
    rng = random.Random(few)
    names = ["b", "a", None, "ä", "", "z"]
    docs = []
    for i in range(150):
        own = [names[0]] if i % 3 == 0 else rng.sample(names[:5], rng.choice([1, 1, 2]))
        docs.append((i, rng.choice([0, 1, rng.randint(1, 40), 5]), own))
    docs += [(None, 7, ["a"])] * 20 + [(9, 2, ["a", "a"])] * 10 + [(1001, 11, []), (1002, None, ["z"]), (1003, 3, None)]
    df = spark.createDataFrame([(*d, "x", 1, "y") for d in docs], "doc_id bigint, n bigint, from array<string>, key string, size int, pattern string")
    out = mixing.mix_sources(df.repartition(5), F.col("from"), F.col("n"))
    got = out.collect()
    assert sorted(map(repr, ((r.doc_id, r.size) for r in got))) == sorted(repr((d, n or 0)) for d, n, _ in docs)
    # targets: shares by weight, none above three times the source
    size = {s: sum(n or 0 for _, n, own in docs if s in set([None] if own is None else own)) for s in names}
    order = sorted((s for s in names if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, full = sum(size.values()), set()
    while True:
        level = (total - sum(3 * size[s] for s in full)) / sum(weight[s] for s in names if s not in full)
        over = {s for s in names if 3 * size[s] < level * weight[s]} | full
        if over == full:
            break
        full = over
    want = {s: 3 * size[s] if s in full else level * weight[s] for s in names}
    groups, routed = {}, {}
    for r in got:
        assert r["size"] * 3 >= r.taken and (r.taken % r["size"] == 0 if r["size"] else r.taken == 0)
        for s in r.shares:
            assert s.source_size == size[s.source] and s.target == pytest.approx(want[s.source], rel=1e-12)
        key = tuple(repr(s.source) for s in r.shares)
        groups.setdefault(key, []).append(r)
        routed[key] = {s.source: s.words for s in r.shares}
    for s in names:
        assert sum(f.get(s, 0) for f in routed.values()) <= round(want[s])
    for key, rows in groups.items():
        words, flow = sum(r["size"] for r in rows), sum(routed[key].values())
        copies, need = divmod(flow, words) if words else (0, 0)
        digest = lambda r: hashlib.md5(f"{'-' if r.doc_id is None else r.doc_id}:17".encode()).hexdigest()[:18]
        rows = sorted(rows, key=digest)
        picked = brute_fill([(digest(r), r["size"]) for r in rows], need)
        assert sorted((r.doc_id or -1, r.taken) for r in rows) == sorted(
            (r.doc_id or -1, r["size"] * (copies + (i in picked))) for i, r in enumerate(rows))
    again = mixing.mix_sources(df.repartition(3), F.col("from"), F.col("n"))
    seen = lambda rs: sorted((r.doc_id or -1, r.taken) for r in rs)
    assert seen(again.collect()) == seen(got)
    none = mixing.mix_sources(df.where("false"), F.col("from"), F.col("n"))
    assert none.count() == 0 and none.columns == ["doc_id", "size", "shares", "taken"]


def test_word_count(spark):
    texts = [None, "", " ", "a", " a\tb\x0bc\r\nd\x0c ", "x\x1cy z w v", "é" * 9, "a\x00b \x1f", "w " * 200_000]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", mixing.word_count("t").alias("n")).collect()
    for r in got:
        assert r.n == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r.i] or ""))


def test_mixing_query(spark, same):
    names, want = oracle("op11_mix_sources", ["documents"])
    same(queries.op11_mix_sources(spark, SF), want, *names)


# ------------------------------------------------------------ merkle trees
def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_tree(leaves):
    """All rows of nodes from the leaves up."""
    rows = [leaves]
    while len(rows[-1]) > 1:
        rows.append([H(rows[-1][i:i + 3]) for i in range(0, len(rows[-1]), 3)])
    return rows


def brute_manifest(docs):
    """docs: (id, group, leaf, changed) -> rows as the operator's."""
    groups = {}
    for d in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[2])):
        groups.setdefault(d[1], []).append(d)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: brute_tree([d[2] for d in groups[s]]) for s in order}
    top = brute_tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, d in enumerate(groups[s]):
            proof, node, at = [], d[3] or d[2], i
            for rows, start in ((trees[s], i), (top, k)):
                at = start
                for row in rows[:-1]:
                    run = row[at - at % 3:at - at % 3 + 3]
                    proof += run[:at % 3] + run[at % 3 + 1:]
                    node = H([*run[:at % 3], node, *run[at % 3 + 1:]])
                    at //= 3
            out.append((d[0], d[2], trees[s][-1][0], top[-1][0], H(proof), node, node == top[-1][0]))
    return out


@pytest.mark.parametrize("levels", [1, 2, 3, 5, 8])
def test_van_emde_boas_addresses(levels):
    at = merkle.addresses(levels, 3)
    flat = np.concatenate(at)
    assert [len(a) for a in at] == [3 ** d for d in range(levels)]
    assert sorted(flat.tolist()) == list(range(merkle.tree_size(levels, 3)))
    upper = levels // 2
    for d in range(levels):     # the upper half of the levels comes first, each tree below it is one piece
        if d < upper:
            assert at[d].max() < merkle.tree_size(upper, 3)
        elif upper:
            size = merkle.tree_size(levels - upper, 3)
            assert ((at[d] - merkle.tree_size(upper, 3)) // size == np.arange(3 ** d) // 3 ** (d - upper)).all()


@pytest.mark.parametrize("height", [2, 7])
def test_merkle_edges(spark, same, height):
    docs = [(i, "big", H([str(i)]), H(["x", str(i)]) if i % 5 == 0 else None) for i in range(0, 400, 2)]
    docs += [(i, f"s{i % 4}", H([str(i)]), H([str(i)])) for i in range(1, 40, 2)]
    docs += [(7, "same", H(["7"]), None)] * 28 + [(None, "same", H(["n"]), H(["m"])), (None, "same", H(["a"]), None), (5, "same", H(["b"]), H(["c"]))]
    docs += [(1, None, H(["lone"]), None), (2, "", H(["empty"]), H(["e"])), (3, "\U0001F600", H(["e1"]), None), (4, "￮", H(["e2"]), None)]
    schema = "doc_id bigint, source string, leaf string, changed string, pos int, grp string, total int, root string"
    df = spark.createDataFrame([(*d, 1, "x", 1, "y") for d in docs], schema).repartition(6)
    run = lambda d: merkle.manifest(d, F.col("leaf"), F.col("changed"), height=height)
    same(run(df), brute_manifest(docs))
    lone = df.where("source IS NULL")
    same(run(lone), brute_manifest([d for d in docs if d[1] is None]))
    same(run(df.where("source = 'big'")), brute_manifest([d for d in docs if d[1] == "big"]))
    assert run(df.where("false")).count() == 0


def test_merkle_query(spark, same):
    names, want = oracle("op12_merkle_manifest", ["documents"])
    got = queries.op12_merkle_manifest(spark, SF)
    same(got, want, *names)
    assert not all(w[names.index("verified")] for w in want)


def test_row_digest(spark):
    rows = [(1, "ä", None, 3, ""), (None, None, None, None, None), (2, "-", "1:", 0, "tab\t\U0001F600")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, doc_id bigint, source string, lang string, n_chars bigint, text string")
    got = df.select("i", merkle.row_digest(df.columns[1:]).alias("h")).collect()
    for r in got:
        assert r.h == H("-" if v is None else f"{len(str(v).encode())}:{v}" for v in rows[r.i])
