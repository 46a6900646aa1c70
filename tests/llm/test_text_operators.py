import io
import random

import numpy as np
import pytest

from laborlens.llm import bit_planes, bpe_tree, queries, simhash, token_counts
from laborlens.llm.common import token_file
from laborlens.llm.components import components

from . import brute
from .conftest import SF


def empty(docs):
    return docs.where("false")


def test_token_counts(docs, corpus, same):
    same(token_counts.count_tokens(docs), brute.token_counts(corpus))
    assert token_counts.count_tokens(empty(docs)).count() == 0
    assert token_counts.count_tokens(docs.unionAll(docs)).count() == 2 * len(corpus)


def test_token_counts_query(spark, table, same):
    same(queries.op1_token_counts(spark, SF), brute.token_counts(table("documents", "doc_id", "text")))


def test_token_ids(spark, docs, corpus, same):
    for unit, block in (("byte", 1000), ("bit", 64)):
        folder = bit_planes.fresh_folder(spark)
        bit_planes.write_ids(docs, folder, unit=unit, block=block, shards=4)
        same(bit_planes.read_ids(spark, folder), brute.token_ids(corpus))


def test_token_ids_edges(spark, docs, corpus, same):
    folder = bit_planes.fresh_folder(spark)
    bit_planes.write_ids(empty(docs), folder)
    assert bit_planes.read_ids(spark, folder).count() == 0
    folder = bit_planes.fresh_folder(spark)
    bit_planes.write_ids(docs.unionAll(docs), folder)
    same(bit_planes.read_ids(spark, folder), brute.token_ids(corpus + corpus))
    folder = bit_planes.fresh_folder(spark)
    rows = [(None, "b"), (-5, "a"), (None, None), (7, "c")]
    bit_planes.write_ids(spark.createDataFrame(rows, "doc_id bigint, text string"), folder)
    want = brute.token_ids([(-10**9 if d is None else d, t) for d, t in rows])
    same(bit_planes.read_ids(spark, folder), [(None if d == -10**9 else d, *x) for d, *x in want])


def test_token_ids_query(spark, table, same):
    same(queries.op2_token_ids(spark, SF), brute.token_ids(table("documents", "doc_id", "text")))


def test_shard_blocks_by_number():
    sink = io.BytesIO()
    w = bit_planes.ShardWriter(sink, block=50)
    ids = np.random.default_rng(1).integers(0, 2**32, 1234).astype("<u4")
    w.add(5, ids.tobytes())
    w.close()
    r = bit_planes.ShardReader(sink)
    assert (r.ids(7) == ids[350:400]).all() and len(r.index) == 25
    with pytest.raises(ValueError):
        bit_planes.ShardReader(io.BytesIO(sink.getvalue()[:-3]))


def test_codec(docs, corpus, same):
    same(bpe_tree.encode_decode(docs, leaf=64), brute.codec(corpus))
    # texts of over 300 bytes in pieces, encoded in parallel and joined
    same(bpe_tree.encode_decode(docs, leaf=16, spread_bytes=300), brute.codec(corpus))
    assert bpe_tree.encode_decode(empty(docs)).count() == 0
    got = bpe_tree.encode_decode(docs, with_ids=True).select("doc_id", "ids").collect()
    tk, text = brute.tokenizer("byte_bpe_50k.json"), dict(corpus)
    assert all(list(r.ids) == tk.encode(text[r.doc_id] or "", add_special_tokens=False).ids for r in got)


def test_codec_query(spark, table, same):
    same(queries.op6_bpe_codec(spark, SF), brute.codec(table("documents", "doc_id", "text")))


def test_tree_concatenation():
    """Any cut into leaves gives the encoding of the whole string."""
    bpe, rng = bpe_tree.ByteBpe(token_file("byte_bpe_50k.json")), random.Random(3)
    for _ in range(3000):
        s = "".join(rng.choices(rng.choice(["a", "ab", "aabtion", "theingĠo", "!.-="]), k=rng.randint(1, 80)))
        assert bpe_tree.encode_tree(s, bpe.model_tokens, rng.randint(1, 9)) == bpe.model_tokens(s)


def test_simhash(docs, corpus, same):
    same(simhash.near_duplicates(docs), brute.simhash(corpus), "doc_id", "fingerprint", "component_id")
    assert simhash.near_duplicates(empty(docs)).count() == 0
    assert simhash.near_duplicates(docs.unionAll(docs)).count() == 2 * len(corpus)


def test_simhash_query(spark, table, same):
    same(queries.op3_simhash(spark, SF), brute.simhash(table("documents", "doc_id", "text")))


def test_ball_links(spark):
    """Chains of two-bit steps, random points and negative bigints."""
    rng = random.Random(5)
    points = {0, (1 << 64) - 1}
    for _ in range(40):
        p = rng.getrandbits(64)
        for _ in range(rng.randint(1, 6)):
            points.add(p)
            for _ in range(rng.randint(1, 3)):
                p ^= 1 << rng.randrange(64)
    points = sorted(p - (1 << 64) if p >> 63 else p for p in points)
    df = spark.createDataFrame([(p,) for p in points], "fp bigint")
    got = {r.node: r.root for r in components(simhash.ball_links(df, 2)).collect()}
    r = brute.roots(len(points), [(i, j) for i in range(len(points)) for j in range(i)
                                  if ((points[i] ^ points[j]) & (2**64 - 1)).bit_count() <= 2])
    assert [got.get(p, p) for p in points] == [points[k] for k in r]


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(200)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert [got.get(i, i) for i in range(400)] == brute.roots(400, links)
