"""Token-id output in byte planes, and its reader.

A shard file holds the ids of a range of documents, in order.  Ids are cut
into blocks of fixed size; a block is transposed into byte planes (all low
bytes, then all second bytes, ...) or bit planes, and each plane is
compressed with zstandard.  High planes are nearly constant and all but
vanish.  Layout of a file::

    MAGIC | planes of block 0 | planes of block 1 | ... | footer | u64 footer offset | MAGIC

The footer (zstandard, JSON head + int64 arrays) is the chunk index: per block
its offset and the stored size of each plane, per document its id and number
of ids.  A reader seeks to any block without reading those before it.

Shards are written under names that hold the task attempt, and a manifest
table, committed by Spark, names those that count; so a retried or
speculative task leaves at most a stray file that nothing reads.
"""
from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, shuffle_partitions
from .common import MARKS, Known, Pretokens, by_bytes, importable, lean, plain, token_file, whole_text

MAGIC = b"LLBP0001"
NO_ID = -(1 << 63)  # stands for a null id in files
MANIFEST = "shard int, file string, n_docs bigint, n_ids bigint"


# ---------------------------------------------------------------- blocks
def to_planes(ids: np.ndarray, unit: str) -> list[bytes]:
    """The planes of a block of unsigned 32-bit ids, low ones first."""
    bytes_ = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4)
    if unit == "byte":
        return [np.ascontiguousarray(bytes_[:, k]).tobytes() for k in range(4)]
    bits = np.unpackbits(bytes_, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n: int, unit: str) -> np.ndarray:
    if unit == "byte":
        out = np.empty((n, 4), np.uint8)
        for k, p in enumerate(planes):
            out[:, k] = np.frombuffer(p, np.uint8)
    else:
        bits = np.empty((n, 32), np.uint8)
        for k, p in enumerate(planes):
            bits[:, k] = np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little")
        out = np.packbits(bits, axis=1, bitorder="little")
    return out.reshape(-1).view("<u4")


class ShardWriter:
    """Streams documents' ids into one shard; holds at most a block of them."""

    def __init__(self, sink, block: int = 65_536, unit: str = "byte", level: int = 3):
        import zstandard

        self.sink, self.block, self.unit = sink, block, unit
        self.pack = zstandard.ZstdCompressor(level=level).compress
        self.wait, self.index, self.docs, self.lens = bytearray(), [], array("q"), array("q")
        self.at, self.n_ids = sink.write(MAGIC), 0

    def add(self, doc_id: int, ids: bytes) -> None:
        """``ids``: little-endian unsigned 32-bit integers."""
        self.docs.append(doc_id)
        self.lens.append(len(ids) // 4)
        self.n_ids += len(ids) // 4
        self.wait += ids
        size = 4 * self.block
        done = len(self.wait) - len(self.wait) % size
        for i in range(0, done, size):
            self._flush(bytes(self.wait[i:i + size]))
        del self.wait[:done]

    def _flush(self, raw: bytes) -> None:
        ids = np.frombuffer(raw, "<u4")
        row = [self.at, len(ids)]
        for p in to_planes(ids, self.unit):
            z = self.pack(p)
            self.sink.write(z)
            row.append(len(z))
            self.at += len(z)
        self.index.append(row)

    def close(self) -> None:
        if self.wait:
            self._flush(bytes(self.wait))
        head = json.dumps({"unit": self.unit, "block": self.block, "n_ids": self.n_ids,
                           "n_docs": len(self.docs), "n_blocks": len(self.index)}).encode()
        body = (struct.pack("<I", len(head)) + head + self.docs.tobytes() + self.lens.tobytes()
                + np.array(self.index, "<i8").tobytes())
        self.sink.write(self.pack(body))
        self.sink.write(struct.pack("<Q", self.at) + MAGIC)


class ShardReader:
    """Chunk index of a shard, and its blocks by number."""

    def __init__(self, source):
        import zstandard

        self.source, self.unpack = source, zstandard.ZstdDecompressor().decompress
        end = source.seek(0, 2)
        source.seek(end - 16)
        tail = source.read(16)
        if tail[8:] != MAGIC:
            raise ValueError("not a shard file, or cut short")
        at = struct.unpack("<Q", tail[:8])[0]
        source.seek(at)
        body = self.unpack(source.read(end - 16 - at))
        n = struct.unpack_from("<I", body)[0]
        self.head = json.loads(body[4:4 + n])
        docs, blocks = self.head["n_docs"], self.head["n_blocks"]
        rest = np.frombuffer(body, "<i8", offset=4 + n) if (4 + n) % 8 == 0 else np.frombuffer(body[4 + n:], "<i8")
        self.docs, self.lens = rest[:docs], rest[docs:2 * docs]
        self.index = rest[2 * docs:].reshape(blocks, -1)

    def ids(self, block: int) -> np.ndarray:
        at, n, *sizes = (int(x) for x in self.index[block])
        self.source.seek(at)
        raw, planes, i = self.source.read(sum(sizes)), [], 0
        for s in sizes:
            planes.append(self.unpack(raw[i:i + s]))
            i += s
        return from_planes(planes, n, self.head["unit"])

    def documents(self) -> Iterator[tuple[int, int, Iterator[bytes]]]:
        """(doc id, number of ids, its ids as pieces of bytes) in file order;
        one block is held at a time.  Take each document's pieces before the next."""
        block, buf, at = -1, b"", 0

        def pieces(left: int) -> Iterator[bytes]:
            nonlocal block, buf, at
            while left:
                if at == len(buf):
                    block, at = block + 1, 0
                    buf = self.ids(block).tobytes()
                part = buf[at:at + left]
                at += len(part)
                left -= len(part)
                yield part

        for doc, n in zip(self.docs.tolist(), self.lens.tolist(), strict=True):
            yield doc, n, pieces(4 * n)


def _fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri.removeprefix('file:')}")


# --------------------------------------------------------------- encoding
LONG = 1 << 20  # characters
CONTROL = "\x1c\x1d\x1e\x1f"
GAP = re.compile(f"[^\\S{CONTROL}]")
WORDS = re.compile(f"[\\S{CONTROL}]+")


class WordIds:
    """Ids of the lower-casing word tokenizer as little-endian bytes.

    Its pre-tokenizer drops white space and never joins across it, and added
    tokens hold none, so the words of a text are encoded on their own.
    Words of Latin letters, marks after them or not, have their pre-tokens encoded by the
    library's model, which is faster, all others by the whole library.
    Python counts four control characters as white space that the library
    does not; where a text holds one, words are cut without them.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.pretokens = Pretokens(self.tokenizer)
        self.words = Known(self._word)

    def _word(self, word: str) -> bytes:
        letters = word.rstrip(MARKS)
        if plain(letters):  # Latin letters are only lower-cased; a run of marks is one pre-token
            ids = self.pretokens[letters.lower()]
            return ids if letters == word else ids + self.pretokens[word[len(letters):]]
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def ids(self, texts: list[str]) -> list[bytes]:
        return [b"".join(self.pieces(t)) if len(t) > LONG else self._piece(t) for t in texts]

    def pieces(self, text: str) -> Iterator[bytes]:
        """The ids of a long text, some words at a time."""
        at = 0
        while at < len(text):
            m = GAP.search(text, at + LONG)
            end = m.start() if m else len(text)
            yield self._piece(text[at:end])
            at = end

    def _piece(self, text: str) -> bytes:
        words = WORDS.findall(text) if any(c in text for c in CONTROL) else text.split()
        return b"".join(map(self.words.__getitem__, words))


@lru_cache(maxsize=4)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


# -------------------------------------------------------------- operators
def write_ids(docs: DataFrame, out_dir: str, id_col: str = "doc_id", text_col: str = "text",
              tokenizer: str = "word_bpe_49k.json", end_id: int = 2, block: int = 65_536,
              unit: str = "byte", shards: int | None = None, batch_bytes: int = 1 << 20) -> DataFrame:
    """Encode every whole text, append ``end_id`` and write shard files below
    ``out_dir`` (a folder that all executors share) in ascending ``id_col``
    order; returns the manifest.

    A null text is empty (its only id is ``end_id``); rows with the same id
    are documents of their own, in order of a hash of their text; rows with a null id
    come before all others.  Rows of one id spread over shards by their text
    and a number per row.  Of a long text its ids and some words are held.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    importable(spark)
    shards = shards or shuffle_partitions(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, out, n_docs = word_ids(token_file(tokenizer)), None, 0
        end, ctx = array("I", [end_id]).tobytes(), TaskContext.get()
        name = f"shard-{ctx.partitionId():05d}-{ctx.taskAttemptId()}.ids"
        for batch in batches:
            for part in by_bytes(batch, "text", batch_bytes):
                if out is None:
                    fs, root = _fs(out_dir)
                    fs.create_dir(root, recursive=True)
                    sink = fs.open_output_stream(f"{root}/{name}")
                    out = ShardWriter(sink, block, unit)
                ids = encoder.ids(part.column("text").to_pylist())
                for doc, x in zip(part.column("id").to_pylist(), ids, strict=True):
                    out.add(doc, x + end)
                n_docs += len(ids)
        if out is not None:
            out.close()
            sink.close()
            yield pa.RecordBatch.from_pylist(
                [{"shard": ctx.partitionId(), "file": name, "n_docs": n_docs, "n_ids": out.n_ids}],
                schema=pa.schema([("shard", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    src = (docs.select(F.col(id_col).cast("bigint").alias("id"), whole_text(text_col).alias("text"))
           .withColumn("id", F.coalesce("id", F.lit(NO_ID)))
           .withColumn("tie", F.xxhash64("text")).withColumn("nth", F.monotonically_increasing_id())
           .repartitionByRange(shards, "id", "tie", "nth").sortWithinPartitions("id", "tie", "text", "nth").drop("tie", "nth"))
    src.mapInArrow(lean(write), MANIFEST).write.parquet(f"{out_dir}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{out_dir}/manifest")


def read_ids(spark: SparkSession, out_dir: str) -> DataFrame:
    """Per document of a written folder: ``doc_id``, ``start`` (ids before
    it), ``n_tokens``, ``ids_crc32``.  Only the manifest (a row per shard)
    comes to the driver; blocks are decoded where the shard is read."""
    importable(spark)
    rows = sorted(spark.read.schema(MANIFEST).parquet(f"{out_dir}/manifest").collect(), key=lambda r: r["shard"])
    base, parts = 0, []
    for r in rows:
        parts.append((f"{out_dir}/{r['file']}", base))
        base += r["n_ids"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fs, path = _fs(uri)
                with fs.open_input_file(path) as f:
                    out: list[tuple] = []
                    for doc, n, pieces in ShardReader(f).documents():
                        crc = 0
                        for p in pieces:
                            crc = zlib.crc32(p, crc)
                        out.append((doc, start, n, crc))
                        start += n
                        if len(out) == 10_000:
                            yield _rows(out)
                            out = []
                    yield _rows(out)

    def _rows(out: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*out, strict=True)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                          names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = spark.createDataFrame(parts, "uri string, start bigint").repartition(max(1, len(parts)))
    out = files.mapInArrow(lean(read), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))


def fresh_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "token-ids")
