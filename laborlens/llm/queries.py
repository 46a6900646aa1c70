"""One registered query per operator of this package, at its contract's
parameters, over its whole table."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import bit_planes, bpe_tree, chat_format, decontaminate, hard_negatives, language_id, merkle, mixing, simhash, suffix_dedup, token_counts, vectors, warc
from .common import written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), limit=4096)


@query
def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = bit_planes.fresh_folder(spark)
    bit_planes.write_ids(read_table(spark, sf_dir, "documents"), folder, end_id=2)
    return bit_planes.read_ids(spark, folder)


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


#: The conversation that the contract adds: both turns say the same.
ADDED = r"\### Assistant: </turn> ok"


@query
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, 0, "user", ADDED), (-7, 1, "assistant", ADDED)], rows.schema)
    turns = chat_format.canonical_typed(rows.unionByName(added), "conv_id", ["turn", "role", "text"])
    turns = turns.select("conv_id", F.explode("turns").alias("t")).select("conv_id", "t.*")
    output = written(chat_format.format_turns(turns, "conv_id"), "formatted")
    return chat_format.digests(chat_format.parse(output, "conv_id"), "conv_id")


#: Turns in order; a turn's frame is 13 characters, an escaped character two.
ORACLES["op4_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, replace(replace(replace(role, '\', '\b'), '<', '\l'), '#', '\h') AS r,
         replace(replace(replace(text, '\', '\b'), '<', '\l'), '#', '\h') AS x FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r, x)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r, x) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(13 + length(replace(r, chr(10), '\n')) + length(x)) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""


@query
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


#: Every run of words of the documents that is as long as some window, matched as a string.
ORACLES["op5_decontaminate"] = r"""
WITH RECURSIVE src AS (
  SELECT 'd' AS kind, CAST(doc_id AS VARCHAR) AS id, text FROM documents UNION ALL SELECT 'b', CAST(item_id AS VARCHAR), text FROM benchmark
), w AS (
  SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM src
), phrase AS (
  SELECT DISTINCT id, least(len(words), 10) AS n, array_to_string(words[i:i + least(len(words), 10) - 1], ' ') AS phrase
  FROM (SELECT id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM w WHERE kind = 'b' AND len(words) > 0)
), runs AS (
  SELECT id, n, i, array_to_string(words[i:i + n - 1], ' ') AS phrase
  FROM (SELECT id, words, n, unnest(range(1, len(words) - n + 2)) AS i
        FROM (SELECT * FROM w WHERE kind = 'd') CROSS JOIN (SELECT DISTINCT n FROM phrase) WHERE len(words) >= n)
), hits AS (
  SELECT r.id, r.i, r.n, p.id AS item FROM runs r JOIN phrase p ON p.n = r.n AND p.phrase = r.phrase
), found AS (
  SELECT id, count(DISTINCT place) AS n_hit FROM (SELECT id, unnest(range(i, i + n)) AS place FROM hits) GROUP BY id
), items AS (
  SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT id, item FROM hits WHERE item IS NOT NULL) GROUP BY id
)
SELECT doc_id, CAST(len(w.words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM documents d JOIN w ON w.kind = 'd' AND w.id = CAST(d.doc_id AS VARCHAR)
LEFT JOIN found f ON f.id = w.id LEFT JOIN items i ON i.id = w.id"""


@query
def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_tree.encode_decode(read_table(spark, sf_dir, "documents"))


@query
def op7_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.link_vectors(read_table(spark, sf_dir, "embeddings"), threshold=0.95)


#: All pairs, and what links reach by rounds.
ORACLES["op7_vector_links"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), least AS (
  SELECT a, min(b) AS m FROM reach GROUP BY a
), n AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id <= coalesce(m, vec_id) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN least ON least.a = vec_id"""


def language_model(docs: DataFrame) -> language_id.Model:
    """Fitted on documents that aren't held out and whose language is known."""
    return language_id.learn(docs.where(~language_id.held_out()))


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_model(docs))
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


@query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), length=100)


#: Every 100-byte string as hexadecimal text; what one that starts earlier covers, in runs.
ORACLES["op9_suffix_dedup"] = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), pieces AS (
  SELECT doc_id, c, substr(h, 400 * c + 1, 598) AS piece FROM (SELECT doc_id, h, unnest(range(0, CAST(len(h) // 400 + 1 AS BIGINT))) AS c FROM d)
), s AS (
  SELECT doc_id, 200 * c + k AS i, substr(piece, 2 * k + 1, 200) AS w
  FROM (SELECT *, unnest(range(0, CAST(least(len(piece) // 2 - 99, 200) AS BIGINT))) AS k FROM pieces WHERE len(piece) >= 200)
), first AS (
  SELECT w, min((doc_id, i)) AS f FROM s GROUP BY w HAVING count(*) > 1
), again AS (
  SELECT doc_id, i FROM s JOIN first USING (w) WHERE (doc_id, i) <> f
), marked AS (
  SELECT doc_id, i, i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -1000) + 100 AS opens FROM again
), runs AS (
  SELECT doc_id, run, min(i) AS lo, max(i) + 100 AS hi
  FROM (SELECT *, sum(CAST(opens AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked) GROUP BY doc_id, run
), cut AS (
  SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS before FROM runs
), kept AS (
  SELECT doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans, max(hi) AS last,
         string_agg(substr(h, 2 * before + 1, 2 * (lo - before)), '' ORDER BY lo) AS head
  FROM cut JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


@query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.fresh_folder(spark)
    warc.write_archives(read_table(spark, sf_dir, "pages"), folder)
    return warc.records(warc.read_archives(spark, folder, with_data=False))


ORACLES["op10_warc"] = """
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN strlen(h) >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(h) >= 1000 AND page_id <> top THEN top END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages)"""


@query
def op11_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix_sources(docs, F.array("source"), mixing.word_count("text"), weights=(1, 2, 3), most=3)
    own = F.col("shares")[0]
    return mixed.select("doc_id", "size", own["source_size"].alias("source_size"), own["target"].alias("target"), "taken")


#: Targets by rounds; whole documents in seeded order, then what still fits, then the nearest.
ORACLES["op11_mix_sources"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS name, source IS NULL AS none, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         substr(md5(coalesce(CAST(doc_id AS VARCHAR), '-') || ':17'), 1, 18) AS key
  FROM documents
), s AS (
  SELECT name, none, CAST(sum(size) AS BIGINT) AS size, 1 + (row_number() OVER (ORDER BY none, encode(name)) - 1) % 3 AS weight FROM d GROUP BY name, none
), share AS (
  SELECT 0 AS round, CAST(-1 AS BIGINT) AS n, CAST(0 AS DOUBLE) AS level
  UNION ALL
  SELECT round + 1, n2, (words - held) / w FROM (
    SELECT p.round, p.n, count(*) FILTER (3 * s.size < p.level * s.weight) AS n2,
           CAST(sum(s.size) AS DOUBLE) AS words, CAST(coalesce(sum(3 * s.size) FILTER (3 * s.size < p.level * s.weight), 0) AS DOUBLE) AS held,
           sum(s.weight) FILTER (3 * s.size >= p.level * s.weight) AS w
    FROM share p CROSS JOIN s GROUP BY p.round, p.n)
  WHERE n2 <> n AND w > 0
), t AS (
  SELECT name, none, size AS source_size,
         CASE WHEN 3 * size < level * weight THEN CAST(3 * size AS DOUBLE) ELSE level * weight END AS target
  FROM s CROSS JOIN (SELECT level FROM share ORDER BY round DESC LIMIT 1)
), q AS (
  SELECT *, CAST(round(target) AS BIGINT) AS quota, CASE WHEN source_size = 0 THEN 0 ELSE CAST(round(target) AS BIGINT) // source_size END AS copies,
         CASE WHEN source_size = 0 THEN 0 ELSE CAST(round(target) AS BIGINT) % source_size END AS need FROM t
), a AS (
  SELECT d.*, source_size, target, copies, need,
         sum(d.size) OVER (PARTITION BY d.name, d.none ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) <= need AS first
  FROM d JOIN q USING (name, none)
), b AS (
  SELECT *, need - coalesce(sum(size) FILTER (first) OVER (PARTITION BY name, none), 0) AS left1 FROM a
), c AS (
  SELECT *, NOT first AND size <= left1 AND sum(CASE WHEN NOT first AND size <= left1 THEN size ELSE 0 END)
              OVER (PARTITION BY name, none ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) <= left1 AS second FROM b
), e AS (
  SELECT *, left1 - coalesce(sum(size) FILTER (second) OVER (PARTITION BY name, none), 0) AS left2 FROM c
), f AS (
  SELECT *, row_number() OVER (PARTITION BY name, none ORDER BY first OR second OR size = 0, abs(size - left2), key, doc_id) = 1
            AND NOT first AND NOT second AND size > 0 AND abs(size - left2) < left2 AS extra FROM e
)
SELECT doc_id, size, source_size, target, CAST(size * (copies + CAST(first OR second OR extra AS INT)) AS BIGINT) AS taken FROM f"""


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    cut = merkle.row_digest(["doc_id", "source", "lang", "n_chars", F.replace("text", F.lit("\n"), F.lit(""))])
    return merkle.manifest(docs, merkle.row_digest(["doc_id", "source", "lang", "n_chars", "text"]), F.when(tampered, cut))


def _part(c: str) -> str:
    return f"coalesce(strlen({c}) || ':' || {c}, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_part(c) for c in ('CAST(doc_id AS VARCHAR)', 'source', 'lang', 'CAST(n_chars AS VARCHAR)', text))})"


#: CRC-32 by its bits; trees by rounds of runs of three; a row per document and level of its proof.
ORACLES["op12_merkle_manifest"] = f"""
WITH RECURSIVE rows AS (
  SELECT *, coalesce('=' || source, '') AS tree, {_leaf('text')} AS leaf, {_leaf("replace(text, chr(10), '')")} AS cut,
         list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                     lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]),
                                              lambda x, y: xor(x >> 1, (x & 1) * 3988292384))) AS crc
  FROM documents
), leaves AS (
  SELECT *, row_number() OVER () AS r, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS n,
         CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN cut ELSE leaf END AS folded FROM rows
), nodes AS (
  SELECT tree, 0 AS level, pos, leaf AS d, n FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 3, sha256(string_agg(d, '' ORDER BY pos)), (n + 2) // 3 FROM nodes WHERE n > 1
  GROUP BY tree, level, pos // 3, n
), subroots AS (
  SELECT tree, level AS height, d, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS level, pos, d, n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, sha256(string_agg(d, '' ORDER BY pos)), (n + 2) // 3 FROM tops WHERE n > 1 GROUP BY level, pos // 3, n
), steps AS (
  SELECT r, s.level, s.d, s.pos, l.pos // CAST(pow(3, s.level) AS BIGINT) AS own
  FROM leaves l JOIN nodes s ON s.tree = l.tree AND s.n > 1 AND s.pos // 3 = l.pos // CAST(pow(3, s.level + 1) AS BIGINT)
  UNION ALL
  SELECT r, height + s.level, s.d, s.pos, g.pos // CAST(pow(3, s.level) AS BIGINT)
  FROM leaves l JOIN subroots g USING (tree) JOIN tops s ON s.n > 1 AND s.pos // 3 = g.pos // CAST(pow(3, s.level + 1) AS BIGINT)
), path AS (
  SELECT r, level, coalesce(string_agg(d, '' ORDER BY pos) FILTER (pos < own), '') AS before,
         coalesce(string_agg(d, '' ORDER BY pos) FILTER (pos > own), '') AS after FROM steps GROUP BY r, level
), folds AS (
  SELECT r, 0 AS level, folded AS d FROM leaves
  UNION ALL
  SELECT r, f.level + 1, sha256(before || d || after) FROM folds f JOIN path USING (r, level)
), ends AS (
  SELECT r, arg_max(d, level) AS folded_root FROM folds GROUP BY r
), proofs AS (
  SELECT r, sha256(string_agg(before || after, '' ORDER BY level)) AS proof FROM path GROUP BY r
)
SELECT doc_id, leaf, g.d AS subroot, t.d AS root, coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = t.d AS verified
FROM leaves l JOIN subroots g USING (tree) JOIN (SELECT d FROM tops WHERE n = 1) t ON true
JOIN ends USING (r) LEFT JOIN proofs USING (r)"""


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    seventh = F.col("vec_id") % 7 == 0
    label = F.when(seventh, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows, anchor=F.col("vec_id") % 50 == 0, label=label)


#: All rows against the anchors; doubles hold these inner products exactly.
ORACLES["op13_hard_negatives"] = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, c.r AS other, c.vec_id AS other_id, a.label = c.label AS same,
         CAST(list_inner_product(a.q, c.q) AS BIGINT) AS score
  FROM v a JOIN v c ON a.r <> c.r AND len(a.q) = len(c.q) WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor, anchor_id, other_id AS positive_id, score AS positive_score, other AS positive
  FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id, other) <= 5
)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INT) AS rank, s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.other_id, s.other)
QUALIFY row_number() OVER w <= 3"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
