"""Byte-level BPE encoding and decoding of whole texts.

Texts are cut at boundaries the pre-tokenizer always makes, and units that
come again are looked up.  A long pre-token, which the merges see as
one string, is encoded by tree concatenation: halves down to leaves are
encoded on their own and joined by re-encoding a growing window around each
join until its outer tokens on both sides agree with those already there.
The pieces of very long texts are encoded in parallel tasks.
"""
from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .common import MARKS, PRINTED, Known, Pretokens, by_bytes, importable, lean, plain, token_file, whole_text, written

# fixed values: white space in Unicode, and characters that regular-expression
# libraries do not agree on; texts with one of the latter are one unit
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
UNSURE = "\x1c\x1d\x1e\x1f\u180e\u200b\ufeff"
UNIT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")

Token = tuple[int, str]


def join(left: list[Token], right: list[Token], encode: Callable[[str], list[Token]]) -> list[Token]:
    """The encoding of two strings put together, from their own encodings.

    A token sequence is the encoding of its string exactly if each two
    neighbours are the encoding of theirs.  Pairs inside ``left``, the window
    and ``right`` are so by construction.  If the window begins with the
    token that ``left`` has there, the pair across its left edge is one of
    ``left``'s own, and the same on the right; then the whole is exact.
    Else the window is doubled, up to both whole sides.
    """
    if not left or not right:
        return left or right
    m = 2
    while True:
        a, b = left[-m:], right[:m]
        w = encode("".join(t for _, t in a) + "".join(t for _, t in b))
        if (len(a) == len(left) or w[0] == a[0]) and (len(b) == len(right) or w[-1] == b[-1]):
            return left[:len(left) - len(a)] + w + right[len(b):]
        m *= 2


def encode_tree(text: str, encode: Callable[[str], list[Token]], leaf: int) -> list[Token]:
    """Leaves of ``leaf`` characters, joined pairwise level by level."""
    level = [encode(text[i:i + leaf]) for i in range(0, len(text), leaf)]
    while len(level) > 1:
        level = [join(level[i], level[i + 1], encode) if i + 1 < len(level) else level[i]
                 for i in range(0, len(level), 2)]
    return level[0] if level else []


class ByteBpe:
    """The tokenizers library's byte-level BPE, by units and trees.

    A unit is a run of white space and the run of other characters after it.
    The pre-tokenizer never joins a character to white space that follows
    it, looks ahead only within a unit, and added tokens hold no white
    space; so a text's encoding is that of its units, one after another.
    """

    def __init__(self, path: str, leaf: int = 2048):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.leaf, self.pretokens, self.units = leaf, Pretokens(self.tokenizer), Known(self._unit)
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.added = added
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        byte = {c: b for b, c in PRINTED.items()}
        special = set(added.values())
        self.bytes = [b""] * self.tokenizer.get_vocab_size(with_added_tokens=True)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            plain = i not in special and all(c in byte for c in token)
            self.bytes[i] = bytes(byte[c] for c in token) if plain else token.encode()
        self.decimal = [str(i) for i in range(len(self.bytes))]
        self.name = {i: t for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}

    def model_tokens(self, text: str) -> list[Token]:
        return [(t.id, t.value) for t in self.tokenizer.model.tokenize(text)]

    def _long(self, unit: str) -> array:
        out = array("I")
        for part in self.cut.split(unit) if self.cut else [unit]:
            if part in self.added:
                out.append(self.added[part])
            elif part:
                for token, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(part):
                    out.extend(i for i, _ in encode_tree(token, self.model_tokens, self.leaf))
        return out

    def _unit(self, unit: str) -> bytes:
        if len(unit) > self.leaf:
            return self._long(unit).tobytes()
        lead = unit[:1] if unit[0] in " \n" else ""
        body = unit[len(lead):]
        letters = body.rstrip(MARKS)
        if plain(letters):
            # a space belongs to the letters after it, a newline stands alone, and so does a run of marks
            ids = self.pretokens[" " + letters] if lead == " " else self.pretokens[letters]
            if lead == "\n":
                ids = self.pretokens["\n"] + ids
            return ids if letters == body else ids + self.pretokens[body[len(letters):]]
        return array("I", self.tokenizer.encode(unit, add_special_tokens=False).ids).tobytes()

    def encode(self, texts: list[str]) -> list[array]:
        out, get = [], self.units.__getitem__
        for t in texts:
            out.append(ids := array("I"))
            ids.frombytes(b"".join(map(get, [t] if any(c in t for c in UNSURE) else UNIT.findall(t))))
        return out

    def decode(self, ids: array) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")

    def listed(self, ids: array) -> str:
        return ",".join(map(self.decimal.__getitem__, ids))


@lru_cache(maxsize=4)
def byte_bpe(path: str, leaf: int) -> ByteBpe:
    return ByteBpe(path, leaf)


def pieces(bpe: ByteBpe, text: str, size: int) -> Iterator[tuple[bool, bool, str]]:
    """A long text as (whether it is part of one pre-token, whether it goes
    on with the piece before, piece).  Units are put together up to ``size``
    characters; of a longer unit, a pre-token of over ``size`` is cut
    anywhere, its parts in the byte-level alphabet."""
    held, n = [], 0
    for unit in [text] if any(c in text for c in UNSURE) else UNIT.findall(text):
        if n and n + len(unit) > size:
            yield False, False, "".join(held)
            held, n = [], 0
        if len(unit) <= size:
            held.append(unit)
            n += len(unit)
            continue
        for part in bpe.cut.split(unit) if bpe.cut else [unit]:
            if part in bpe.added:
                yield False, False, part
            elif part:
                for token, _ in bpe.tokenizer.pre_tokenizer.pre_tokenize_str(part):
                    for k in range(0, len(token), size):
                        yield True, k > 0, token[k:k + size]
    if held:
        yield False, False, "".join(held)


def put_together(bpe: ByteBpe, parts: list[tuple[bool, array]]) -> array:
    """The ids of a text from those of its pieces: pieces that go on with the
    one before are joined pairwise, level by level, the others follow."""
    out, chain = array("I"), []

    def close() -> None:
        level = chain
        while len(level) > 1:
            level = [join(level[i], level[i + 1], bpe.model_tokens) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        for tokens in level:
            out.extend(i for i, _ in tokens)

    for goes_on, ids in parts:
        if not goes_on:
            close()
            chain = []
        chain.append([(i, bpe.name[i]) for i in ids])
    close()
    return out


def long_ids(docs: DataFrame, tokenizer: str, leaf: int, size: int) -> DataFrame:
    """Ids of long texts: their pieces are rows that are encoded in parallel
    tasks, and brought together per text."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(token_file(tokenizer), leaf)
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text"), strict=True):
                got = [(row, no, *p) for no, p in enumerate(pieces(bpe, text.as_py(), size))]
                cols = list(zip(*got, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(token_file(tokenizer), leaf)
        for batch in batches:
            ids = [(array("I", [i for i, _ in encode_tree(p, bpe.model_tokens, leaf)]) if inner else bpe.encode([p])[0]).tobytes()
                   for inner, p in zip(batch.column("inner").to_pylist(), batch.column("piece").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("no"), batch.column("goes_on"), pa.array(ids, pa.binary())],
                                             names=["row", "no", "goes_on", "ids"])

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        bpe = byte_bpe(token_file(tokenizer), leaf)
        parts = sorted(zip(table.column("no").to_pylist(), table.column("goes_on").to_pylist(), table.column("ids").to_pylist(), strict=True))
        ids = put_together(bpe, [(goes_on, array("I", x)) for _, goes_on, x in parts])
        return pa.table({"row": pa.array([key[0].as_py()], pa.int64()), "ids": pa.array([ids.tobytes()], pa.binary())})

    names, kinds = ["row", "no", "inner", "goes_on", "piece"], [pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
    rows = docs.mapInArrow(lean(cut), "row bigint, no bigint, inner boolean, goes_on boolean, piece string")
    done = rows.repartition(shuffle_partitions(docs.sparkSession), "row", "no").mapInArrow(
        lean(encode), "row bigint, no bigint, goes_on boolean, ids binary")
    return done.groupBy("row").applyInArrow(lean(gather), "row bigint, ids binary")


def digest_rows(bpe: ByteBpe, own: pa.Array, ids: list[array], with_ids: bool) -> pa.RecordBatch:
    cols = [own, pa.array([len(x) for x in ids], pa.int64()),
            pa.array([hashlib.sha256(bpe.listed(x).encode()).hexdigest() for x in ids], pa.string()),
            pa.array([hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in ids], pa.string())]
    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
    if with_ids:
        ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
        flat = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(x.tobytes() for x in ids))])
        cols.append(pa.ListArray.from_arrays(pa.array(ends), flat))
        names.append("ids")
    return pa.RecordBatch.from_arrays(cols, names=names)


def encode_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  tokenizer: str = "byte_bpe_50k.json", leaf: int = 2048, with_ids: bool = False,
                  batch_bytes: int = 1 << 20, spread_bytes: int = 8 << 20) -> DataFrame:
    """Per row: ``id_col``, ``n_tokens``, ``ids_sha256`` (of the decimal ids
    joined by commas), ``decoded_sha256`` (of the text that the ids decode
    to) and, on request, ``ids`` themselves.

    A null text is empty: no ids, and the digests of the empty string.
    Repeated rows give repeated results; other columns are ignored.  Texts of
    more than ``spread_bytes`` are cut into pieces that parallel tasks
    encode; all others are encoded where they are read.
    """
    spark = docs.sparkSession
    importable(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(token_file(tokenizer), leaf)
        for batch in batches:
            for part in by_bytes(batch, "text", batch_bytes):
                yield digest_rows(bpe, part.column("id"), bpe.encode(part.column("text").to_pylist()), with_ids)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(token_file(tokenizer), leaf)
        for batch in batches:
            for k in range(batch.num_rows):
                yield digest_rows(bpe, batch.column("id").slice(k, 1), [array("I", batch.column("ids")[k].as_py())], with_ids)

    src = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    big = F.octet_length("text") > spread_bytes
    if src.where(big).isEmpty():
        out = src.mapInArrow(lean(run), schema)
    else:
        long = written(src.where(big).withColumn("row", F.monotonically_increasing_id()), "long-texts")
        ids = long.select("row", "id").join(long_ids(long.select("row", "text"), tokenizer, leaf, max(leaf, spread_bytes // 8)), "row")
        out = src.where(~big).mapInArrow(lean(run), schema).unionByName(ids.select("id", "ids").mapInArrow(lean(finish), schema))
    return out.withColumnRenamed("id", id_col)
