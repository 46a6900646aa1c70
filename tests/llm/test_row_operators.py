import json
import random

import numpy as np
import pytest

from laborlens.llm import chat_format, decontaminate, language_id, queries, suffix_dedup, vectors, warc

from . import brute
from .conftest import SF

CHAT = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")


def formatted(spark, rows):
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    out = chat_format.format_turns(df, "conv_id")
    return out, chat_format.digests(chat_format.parse(out, "conv_id"), "conv_id")


def test_chat_round_trip(spark, same):
    rows = [(1, 0, "user", "hi\n### x </turn>\n"), (1, 1, "assistant", r"\b\l\h \\ <\l"), (2, 5, "assistant", None), (2, 4, None, ""),
            (3, 0, "a\nb#<\\", "é👍"), (3, 0, "a\nb#<\\", "é👍"), (4, 0, "assistant", "x" * 50_000), (4, 0, "assistant", "</turn>\n"),
            (None, 0, "user", "no id"), (5, None, "user", "no turn"), (5, 0, "assistant", "then")]
    out, got = formatted(spark, rows)
    want = list(brute.chat([(c, -1 if t is None else t, r, x) for c, t, r, x in rows]))
    same(got, want, *CHAT)
    for r in out.collect():
        for s in r.loss_spans:
            assert r.formatted[s.start + s.length:].startswith(chat_format.END)
            assert r.formatted[:s.start].endswith("### assistant\n")
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat_format.canonical_typed(none, "conv_id", ["turn", "role", "text"]).count() == 0
    assert chat_format.digests(chat_format.parse(chat_format.format_turns(none, "conv_id"), "conv_id"), "conv_id").count() == 0


def test_chat_query(spark, table, same):
    rows = table("conversations", "conv_id", "turn", "role", "text") + [(-7, 0, "user", queries.ADDED), (-7, 1, "assistant", queries.ADDED)]
    got = queries.op4_chat_format(spark, SF)
    same(got, brute.chat(rows), *CHAT)
    assert got.where("formatted_chars <= loss_chars").count() == 0


def test_chat_layouts(spark):
    records = {
        "messages": ({"messages": [{"role": "human", "content": "q"}, {"content": "a", "role": "gpt"}]}, [("user", "q"), ("assistant", "a")]),
        "from_value": ({"conversations": [{"from": "human", "value": "[1"}, {"from": "gpt", "value": '{"x":1}'}]}, [("user", "[1"), ("assistant", '{"x":1}')]),
        "prompt_response": ({"response": "a", "prompt": '[{"role": 1}]'}, [("user", '[{"role": 1}]'), ("assistant", "a")]),
        "instruction": ({"instruction": "i", "output": "o"}, [("user", "i"), ("assistant", "o")]),
        "instruction_input": ({"instruction": "i", "input": "n", "output": None}, [("user", "i\n\nn"), ("assistant", "")]),
        "turn_row": ({"turn": 3, "role": "user", "text": "t"}, [("user", "t")]),
        None: ({"other": {"prompt": 1}}, None),
    }
    rows = [(i, json.dumps(r)) for i, (r, _) in enumerate(records.values())] + [(90, None), (91, "not json"), (92, "[]"), (93, '"x"')]
    got = {r.i: r for r in chat_format.canonical_json(spark.createDataFrame(rows, "i bigint, r string"), "i", "r").collect()}
    for i, (name, (_, turns)) in enumerate(records.items()):
        assert got[i].layout == name
        assert (got[i].turns and [(t.role, t.text or "") for t in got[i].turns]) == turns
    assert all(got[i].layout is None and got[i].turns is None for i in (90, 91, 92, 93))
    typed = spark.createDataFrame([(1, [("human", "q"), ("gpt", None)])], "i bigint, conversations array<struct<`from`:string, value:string>>")
    r = chat_format.canonical_typed(typed, "i", ["conversations"]).first()
    assert r.layout == "from_value" and [(t.turn, t.role, t.text) for t in r.turns] == [(0, "user", "q"), (1, "assistant", None)]
    with pytest.raises(ValueError):
        chat_format.canonical_typed(typed.withColumnRenamed("conversations", "x"), "i", ["x"])


def test_decontamination(spark, docs, corpus, same):
    base = max((t for _, t in corpus if t and "changed" in t), key=len)
    w = base.split()
    items = [(1, " ".join(w[20:60])), (10, " ".join(w[25:37]).upper()), (2, "two WORDS!"), (3, None), (4, "..."), (5, "one"), (6, "never said this"),
             (7, " ".join(w[40:52])), (7, " ".join(w[40:52])), (8, "orre " * 12), (9, "Straße, 日本")]
    bench = spark.createDataFrame([(*x, "x", 1) for x in items], "item_id bigint, text string, term string, row int")
    want = list(brute.contamination(corpus, items))
    same(decontaminate.contamination(docs, bench), want)
    same(decontaminate.contamination(docs, bench, broadcast_bytes=0), want)
    assert decontaminate.contamination(docs, bench.where("false")).where("contaminated").count() == 0
    assert decontaminate.contamination(docs.where("false"), bench).count() == 0
    same(decontaminate.contamination(docs.unionAll(docs), bench), want + want)


def test_decontamination_shuffles_neighbours_only(spark, monkeypatch):
    """Where the anchors aren't broadcast, no row of the join holds a
    document's words."""
    plans, keep = {}, decontaminate.written
    monkeypatch.setattr(decontaminate, "written", lambda df, name: plans.setdefault(name, df) and keep(df, name))
    docs = spark.createDataFrame([(1, " ".join(f"w{i % 50}" for i in range(5000)))], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(12)))], "item_id bigint, text string")
    assert decontaminate.contamination(docs, items, broadcast_bytes=0).first().n_hit == 1200

    def sides(node):
        below = [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Join":
            yield from below
        for b in below:
            yield from sides(b)

    outs = [{s.output().apply(i).name() for i in range(s.output().size())}
            for s in sides(plans["postings"]._jdf.queryExecution().optimizedPlan())]
    assert any("around" in o for o in outs) and not any("words" in o for o in outs)


def test_decontamination_query(spark, table, same):
    same(queries.op5_decontaminate(spark, SF), brute.contamination(table("documents", "doc_id", "text"), table("benchmark", "item_id", "text")))


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "x alpha beta gamma y"), (2, "alpha q beta r gamma"), (3, "gamma beta alpha"), (4, "alpha beta only")],
                                 "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "Alpha beta gamma")], "item_id bigint, text string")
    anchor = decontaminate.anchors(docs, decontaminate.test_windows(items).select("phrase"))
    index = decontaminate.build_index(docs, anchor, reach=4)
    got = {(r.id, r.exact) for r in decontaminate.phrase_matches(index, anchor, slop=2).collect()}
    assert got == {(1, True), (2, False), (3, False)}


def make_vectors(n=900, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for i in range(0, n // 3, 3):
        x[i + 1] = x[i] + rng.normal(size=dim) * 0.04
        x[i + 2] = x[i + 1] * 3 + rng.normal(size=dim) * 0.1
    x[600:660] = x[600]
    x[700:760] = x[700] + rng.normal(size=(60, dim)) * 0.05
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows[5], rows[6], rows[7], rows[8], rows[9] = (5, None), (6, [0.0] * dim), (7, [1.0, None] * 8), (8, [float("nan")] * dim), (9, [float("inf")] + [1.0] * (dim - 1))
    return rows + [(n, []), (n + 1, [1.0, 2.0]), (n + 2, [2.0, 4.0]), (n + 3, [1e-200, 2e-200]), (n + 4, [-1.0, -2.0]), (n + 5, [0.0, -0.0])]


def test_vectors_against_all_pairs(spark, same):
    rows = make_vectors()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id bigint, embedding array<double>, node int, n int").repartition(4)
    want = brute.vectors(rows)
    # one cell: every pair is compared, in small blocks
    same(vectors.link_vectors(df, cell_rows=10_000, block=64), want)
    # many cells: recall against all pairs, and no link below the threshold
    got = {r.vec_id: r.n_links for r in vectors.link_vectors(df, cell_rows=32, block=32).collect()}
    exact = {w[0]: w[1] for w in want}
    assert all(got[i] <= n for i, n in exact.items())
    assert sum(got.values()) >= 0.97 * sum(exact.values())
    assert vectors.link_vectors(df.where("false")).count() == 0


def test_vectors_count_in_any_shared_cell():
    """Each pair counts once, in the smallest cell that both probe, also if
    it is home to neither."""
    x = np.array([[1.0, 0.0], [1.0, 0.0], [1.0, 0.0]])
    probed = np.array([[1, 5, 7], [2, 5, 7], [9, 5, 3]])
    got = {}
    for cell in range(10):
        at = np.flatnonzero((probed == cell).any(axis=1))
        rows = {"x": x[at], "probed": probed[at], "home": probed[at, 0], "side": np.zeros(len(at), int), "node": at, "n": np.array([1, 10, 100])[at]}
        for node, links, root in zip(*vectors.compare(rows, cell, True, 0.95), strict=True):
            got[int(node)] = got.get(int(node), 0) + int(links)
            assert cell == 5 and root == 0
    assert got == {0: 110, 1: 101, 2: 11}


@pytest.mark.parametrize("cells", [40, 391, 4096])
def test_vectors_recall_at_the_threshold(spark, monkeypatch, cells):
    """Planted pairs of different vectors, each counted once, per band of
    their cosine.  The cells come from a default sample of other vectors, as
    they all but do in a table of 512 rows a cell."""
    rng, dim, n = np.random.default_rng(5), 64, 2000
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    a, side = unit(rng.normal(size=(n, dim))), rng.normal(size=(n, dim))
    side = unit(side - (side * a).sum(1, keepdims=True) * a)
    cos = rng.uniform(0.95001, 0.97, n)
    b = cos[:, None] * a + np.sqrt(1 - cos**2)[:, None] * side
    fitted = {dim: vectors.spherical_kmeans(unit(rng.normal(size=(16_384, dim))), cells)}
    monkeypatch.setattr(vectors, "fit_cells", lambda *_: fitted)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.concatenate([a, b]))], "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r.n_links for r in vectors.link_vectors(df.repartition(8)).collect()}
    found = np.array([got[i] for i in range(n)])
    assert set(got.values()) <= {0, 1} and all(got[i] == got[i + n] for i in range(n))
    recall = {low: found[(cos >= low) & (cos < low + 0.01)].mean() for low in (0.95, 0.96)}
    assert min(recall.values()) >= 0.97


def test_vectors_query(spark, table):
    rows = table("embeddings", "vec_id", "embedding")
    want, got = brute.vectors(rows), queries.op7_vector_links(spark, SF).collect()
    assert len(got) == len(rows) and sum(r.n_links for r in got) >= 0.99 * sum(w[1] for w in want)


def test_language_query(spark, table):
    got = queries.op8_language_id(spark, SF).collect()
    lang = dict(table("documents", "doc_id", "lang"))
    assert len(got) == len(lang) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert held and np.mean([r.lang_pred == lang[r.doc_id] for r in held]) >= 0.97


def test_language_edges(spark, docs):
    rng = random.Random(4)
    words = {"aa": ["lorem", "ipsum", "dolor"], "bb": ["quick", "brown", "fox"], "cc": ["été", "çà", "où"]}
    train = spark.createDataFrame([(i, " ".join(rng.choices(words[k], k=20)), k) for i, k in enumerate(list(words) * 30)]
                                  + [(900, None, "aa"), (901, "text", None), (902, "", "bb")], "doc_id bigint, text string, lang string")
    model = language_id.learn(train)
    assert sorted(model.langs) == ["aa", "bb", "cc"]
    texts = ["quick fox", "Lorem IPSUM", "où", "", None, "123 -- !", "日本語", "x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(df, model).collect()}
    assert [got[i][0] for i in range(6)] == ["bb", "aa", "cc", "und", "und", "und"]
    assert got[0][1] == 1.0 and got[3][1] == 0.0 and got[6][0] in model.langs and got[6][1] == 0.0
    none = language_id.learn(train.where("false"))
    assert {r.lang_pred for r in language_id.identify(df, none).collect()} == {"und"}
    assert language_id.identify(df.where("false"), model).count() == 0
    assert language_id.identify(docs, model, keep=["doc_id", "shard"]).columns == ["doc_id", "shard", "lang_pred", "score"]


def test_language_masks():
    """More than 64 languages take more than a word of bits per slot."""
    langs = [f"l{i:03}" for i in range(70)]
    words = {x: "".join(chr(0x4E00 + 50 * i + j) for j in range(12)) for i, x in enumerate(langs)}
    slots = np.zeros((1 << 12, 2), np.uint64)
    for i, x in enumerate(langs):
        h, _ = language_id.grams([words[x]])
        for k in range(2):
            np.bitwise_or.at(slots, (language_id._slot(h, k, 1 << 12), i // 64), np.uint64(1) << np.uint64(i % 64))
    full = np.array([((slots[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(70)])
    pred, score = language_id.decide(language_id.Model(langs, slots, full**2, 2), [words[x] for x in langs])
    assert pred == langs and min(score) > 0.9


def test_suffix_dedup(docs, corpus, same):
    for kw in ({}, {"gram": 50, "shard_bytes": 4000, "crowd": 3}, {"gram": 90, "shard_bytes": 1}):
        same(suffix_dedup.remove_repeats(docs, **kw), brute.repeats(corpus))
    assert suffix_dedup.remove_repeats(docs.where("false")).count() == 0
    out = suffix_dedup.remove_repeats(docs, with_text=True, keep=["shard", "start"])
    assert out.columns[-3:] == ["kept_text", "shard", "start"]
    twice = suffix_dedup.remove_repeats(docs.unionAll(docs)).groupBy().sum("n_bytes", "n_removed").first()
    once = suffix_dedup.remove_repeats(docs).groupBy().sum("n_bytes", "n_removed").first()
    assert twice[0] == 2 * once[0] and twice[1] > once[1] + 0.5 * once[0] - 20_000


def test_suffix_dedup_query(spark, table, same):
    same(queries.op9_suffix_dedup(spark, SF), brute.repeats(table("documents", "doc_id", "text")))


def test_warc(spark, same):
    big = "é" * 5000
    pages = [(1, "http://a/", big), (2, None, big), (9, "x\r\ny", big), (3, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"),
             (7, "u", "WARC/1.1\r\n\r\n" * 300), (8, "u", "z" * 3_000_000), (10, "u", "z" * 3_000_000)]
    df = spark.createDataFrame([(*p, 1, "x") for p in pages], "page_id bigint, url string, html string, size int, sha1 string").repartition(3)
    folder = warc.fresh_folder(spark)
    warc.write_archives(df, folder, chunk=1000)
    same(warc.records(warc.read_archives(spark, folder, chunk=777)), brute.archives([(p, h) for p, _, h in pages]))
    chunks = warc.read_archives(spark, folder, chunk=777).where("page_id = 9").orderBy("chunk_no").collect()
    assert b"".join(c.data for c in chunks).decode() == big and max(len(c.data) for c in chunks) == 777
    assert [c.offset for c in chunks] == [777 * c.chunk_no for c in chunks]
    folder = warc.fresh_folder(spark)
    warc.write_archives(df.where("false"), folder)
    assert warc.read_archives(spark, folder).count() == 0


def test_warc_query(spark, table, same):
    same(queries.op10_warc(spark, SF), brute.archives(table("pages", "page_id", "html")))
