import subprocess
import sys
import zlib

import corpus_pipeline as P

from . import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def docs_of(spark, corpus):
    lang = ["en", "de", "fr"]
    return spark.createDataFrame([(d, t, lang[d % 3], f"s{d % 2}", len(t or "")) for d, t in corpus],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(4)


def read(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_against_brute_force(spark, corpus, tmp_path):
    sf = str(tmp_path)
    long = max((t for _, t in corpus if t), key=lambda t: len(t.split()))
    passage = " ".join(long.split()[100:130])
    spark.createDataFrame([(1, passage), (2, None), (3, "")], "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = docs_of(spark, corpus)
    docs.write.parquet(f"{sf}/documents.parquet")
    at = dict(corpus)
    stages = dict(P.STAGES)

    out = stages["language_id"](spark, docs, sf)
    assert out.columns == COLUMNS
    at = {d: t for d, t in at.items() if any(map(str.isalpha, t or ""))}
    assert read(out) == at

    out = stages["simhash_near_dedup"](spark, out, sf)
    assert out.columns == COLUMNS
    at = {d: at[d] for d, _, c in brute.simhash(list(at.items())) if d == c}
    assert read(out) == at
    assert read(stages["simhash_near_dedup"](spark, out.unionAll(out), sf)) == at

    out = stages["suffix_array_dedup"](spark, out, sf)
    assert out.columns == COLUMNS
    cut = {d: k for d, *_, k in brute.repeats(list(at.items()))}
    got = read(out)
    assert got.keys() == at.keys()
    assert all(brute.sha(got[d]) == cut[d] for d in got if got[d].isascii())
    assert {r.doc_id: r.n_chars for r in out.collect()} == {d: len(t) for d, t in got.items()}
    at = got

    out = stages["benchmark_decontamination"](spark, out, sf)
    assert out.columns == COLUMNS
    bad = {d for d, *_, hit in brute.contamination(list(at.items()), [(1, passage)]) if hit}
    at = {d: t for d, t in at.items() if d not in bad}
    assert bad and read(out) == at

    out = stages["bpe_encoding"](spark, out, sf)
    want = sorted(brute.codec(list(at.items())))
    assert sorted(tuple(r)[:4] for r in out.collect()) == want
    assert sorted(tuple(r)[:4] for r in P.run(spark, sf).collect()) == want
    none = docs.where("false")
    for stage in stages.values():
        none = stage(spark, none, sf)
    assert none.count() == 0


def test_null_and_repeated_ids_are_rows_of_their_own(spark, tmp_path):
    """Both stages keep or drop rows, not ids."""
    say = lambda w, n=40: " ".join(f"{w}{i}" for i in range(n))
    leak = say("leak", 12)
    rows = [(None, say("a")), (None, say("b")), (None, say("b")), (None, say("c") + " " + leak), (7, say("d")), (7, say("e")), (7, say("f") + " " + leak),
            (3, say("d")), (9, say("a")), (5, None), (None, None)]
    spark.createDataFrame([(1, leak)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
    stages = dict(P.STAGES)

    def got(df):
        assert df.columns == COLUMNS
        return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)

    kept = [(9, say("a")), (None, say("b")), (None, say("c") + " " + leak), (3, say("d")), (7, say("e")), (7, say("f") + " " + leak), (5, None)]
    out = stages["simhash_near_dedup"](spark, docs, str(tmp_path))
    assert got(out) == sorted(kept, key=repr)
    out = stages["benchmark_decontamination"](spark, docs, str(tmp_path))
    assert got(out) == sorted((r for r in rows if leak not in (r[1] or "")), key=repr)


def test_partly_repeated_characters_stay(spark, tmp_path):
    """Bytes repeat from within one character to within another."""
    body = "a" * 120
    pairs = [("\u00e9", "\u0169", "", ""), ("", "", "\u00e9", "\u00e8"), ("\U0001f44d", "\U0001f84d", "\u65e5", "\u65e6")]
    texts = [(f"{p}{i}{body}{r}", f"{q}{i}{body}{s}") for i, (p, q, r, s) in enumerate(pairs)]
    rows = [(2 * i + j, t, "en", "s", len(t)) for i, two in enumerate(texts) for j, t in enumerate(two)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r.doc_id: (r.text, r.n_chars) for r in dict(P.STAGES)["suffix_array_dedup"](spark, docs, str(tmp_path)).collect()}
    seen = set()
    for d, t, *_ in rows:
        b = t.encode()
        starts = [s for s in range(len(b) - 99) if b[s:s + 100] in seen or b[s:s + 100] in {b[k:k + 100] for k in range(s)}]
        seen |= {b[s:s + 100] for s in range(len(b) - 99)}
        gone = {k for s in starts for k in range(s, s + 100)}
        ends = [len(t[:k].encode()) for k in range(len(t) + 1)]
        kept = "".join(c for c, x, y in zip(t, ends, ends[1:], strict=False) if not gone.issuperset(range(x, y)))
        assert got[d] == (kept, len(kept))
    assert got[1][0][:1] == "\u0169" and got[3][0][-1:] == "\u00e8" and got[5][0][-1:] == "\u65e6"


def test_library_does_not_import_this_package():
    code = ("import sys; import laborlens.plans.registry, laborlens.session; "
            "assert not [m for m in sys.modules if m.startswith('laborlens.llm')]")
    subprocess.run([sys.executable, "-c", code], check=True)


def test_language_stage_rejects_what_no_language_claims(spark):
    prose = "the quick brown fox jumps over the lazy dog and runs away into the green wood "
    held_out = next(i for i in range(200, 300) if zlib.crc32(str(i).encode()) % 3 == 1)      # not learned from
    rows = [(i, prose * 3 + str(i), "en", "s", 9) for i in range(30)]
    rows += [(100, "Two words", "en", "s", 9), (held_out, "ҡҙҫғһ " * 40, "en", "s", 9), (102, "ҡҙҫғһ ҡҙ", None, "s", 9),
             (103, None, "en", "s", 9), (104, "42 !", "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = {r.doc_id for r in dict(P.STAGES)["language_id"](spark, docs, "").collect()}
    assert kept == {*range(30), 100, 102}
