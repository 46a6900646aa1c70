"""WARC archives written from and read into a chunked record table.

A payload is never handled as a whole by the writer or the reader: it is rows
of (record, chunk number, bytes).  The writer streams them into a gzip member
per record; the reader streams members back into chunk rows, each with the
SHA-1 of the payload up to its end, so the last chunk of a record carries the
digest of all of it.
"""
from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .bit_planes import _fs
from .common import importable, lean, whole_text

MANIFEST = "file string, n_records bigint"
CHUNKS = ("record_id string, page_id bigint, record_type string, refers_to bigint, url string, chunk_no bigint, "
          "offset bigint, n_bytes bigint, sha1_so_far string, is_last boolean, stored boolean, "
          "payload_bytes bigint, payload_digest string, data binary")


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(urn: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(m[1]) if m else None


# ---------------------------------------------------------------- records
def record_head(page_id: int | None, url: str | None, kind: str, refers_to: int | None, size: int, sha1: str) -> bytes:
    """WARC and HTTP headers of a record.  Of a revisit they are all there
    is; its HTTP headers keep the length of the payload it stands for."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n").encode()
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Target-URI: {uri}",
             "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{sha1}"]
    if kind == "revisit":
        lines += [f"WARC-Refers-To: {_urn(refers_to)}",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(http) + (size if kind == 'response' else 0)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


class Member:
    """One gzip member, streamed into ``sink``."""

    def __init__(self, sink, level: int):
        self.sink, self.z = sink, zlib.compressobj(level, zlib.DEFLATED, 31)

    def write(self, data: bytes) -> None:
        self.sink.write(self.z.compress(data))

    def close(self) -> None:
        self.write(b"\r\n\r\n")
        self.sink.write(self.z.flush())


def inflated(source, piece: int = 1 << 18) -> Iterator[bytes]:
    """The bytes of all members of a gzip file, a bounded piece at a time."""
    z, raw = zlib.decompressobj(31), b""
    while raw or (raw := source.read(piece)):
        if out := z.decompress(raw, piece):
            yield out
        raw = z.unconsumed_tail
        if z.eof:
            raw, z = z.unused_data, zlib.decompressobj(31)


class Stream:
    """Lines and counted bytes from pieces."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.buf, self.at = pieces, b"", 0

    def _more(self) -> bool:
        piece = next(self.pieces, b"")
        self.buf, self.at = self.buf[self.at:] + piece, 0
        return bool(piece)

    def head(self) -> tuple[str, dict[str, str], int] | None:
        """First line, headers by lower-case name and length of a header block; None at the end."""
        while (end := self.buf.find(b"\r\n\r\n", self.at)) < 0:
            if not self._more():
                if self.buf[self.at:].strip():
                    raise ValueError("archive ends inside a record")
                return None
        first, *lines = self.buf[self.at:end].decode().split("\r\n")
        size = end + 4 - self.at
        self.at = end + 4
        return first, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, size

    def skip(self, mark: bytes) -> None:
        if b"".join(self.take(len(mark))) != mark:
            raise ValueError("record is longer than it says")

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if self.at == len(self.buf) and not self._more():
                raise ValueError("archive ends inside a record")
            part = self.buf[self.at:self.at + n]
            self.at += len(part)
            n -= len(part)
            yield part


def record_chunks(source, chunk: int) -> Iterator[dict]:
    """Chunk rows of an archive's records, in order.  A revisit, and a
    response without payload, is one row without bytes."""
    s = Stream(inflated(source))
    while (got := s.head()) is not None:
        first, warc, _ = got
        if not first.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]}")
        _, http, taken = s.head()
        left, kind = int(warc["content-length"]) - taken, warc["warc-type"]
        said, size = warc["warc-payload-digest"].removeprefix("sha1:"), int(http["content-length"])
        row = {"record_id": warc["warc-record-id"], "page_id": _page(warc["warc-record-id"]), "record_type": kind,
               "refers_to": _page(warc.get("warc-refers-to")), "url": warc["warc-target-uri"], "payload_digest": said,
               "payload_bytes": size, "stored": kind == "response"}
        sha1, no, offset, wait = hashlib.sha1(), 0, 0, bytearray()
        for part in s.take(left):
            wait += part
            while len(wait) > chunk:  # what may be the last chunk is held back
                data, wait = bytes(wait[:chunk]), wait[chunk:]
                sha1.update(data)
                yield row | {"chunk_no": no, "offset": offset, "n_bytes": chunk, "is_last": False, "data": data,
                             "sha1_so_far": sha1.hexdigest()}
                no, offset = no + 1, offset + chunk
        sha1.update(wait)
        if kind == "response" and (sha1.hexdigest() != said or left != size):
            raise ValueError(f"payload of {row['record_id']} differs from its digest")
        yield row | {"chunk_no": no, "offset": offset, "n_bytes": len(wait), "is_last": True, "data": bytes(wait),
                     "sha1_so_far": sha1.hexdigest() if kind == "response" else said}
        s.skip(b"\r\n\r\n")


# -------------------------------------------------------------- operators
def write_archives(pages: DataFrame, out_dir: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", chunk: int = 1 << 20, least_shared: int = 1000, level: int = 3) -> DataFrame:
    """Write a record per row below ``out_dir`` (a folder all executors
    share); returns the manifest (``file``, ``n_records``).

    Of records with equal payloads of at least ``least_shared`` bytes, the
    one with the largest id is a response and the others revisit it; smaller
    ones are all responses.  A null payload is empty, a null URL
    ``about:blank``; rows that repeat the largest id are all responses.  A
    null id is never the largest while another is there; its rows are records.
    Other columns are ignored.
    """
    spark = pages.sparkSession
    importable(spark)
    body = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        whole_text(payload_col).cast("binary").alias("body")).withColumns(
        {"sha1": F.sha1("body"), "size": F.octet_length("body").cast("bigint")})
    keep = (body.where(F.col("size") >= least_shared).groupBy("sha1", "size")
            .agg(F.max("page_id").alias("keep"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    other = F.col("keep").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep"))
    rows = body.join(keep, ["sha1", "size"], "left").withColumn("refers_to", F.when(other, F.col("keep")))
    last = F.when(F.col("refers_to").isNotNull() | (F.col("size") == 0), F.lit(0)).otherwise(
        F.floor((F.col("size") - 1) / chunk)).cast("int")
    rows = rows.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), last))).select(
        "page_id", "url", "sha1", "size", "refers_to", "chunk_no",
        F.when(F.col("refers_to").isNull(), F.substring("body", F.col("chunk_no") * chunk + 1, F.lit(chunk))).alias("data"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx, sink, member, n = TaskContext.get(), None, None, 0
        name = f"part-{ctx.partitionId():05d}-{ctx.taskAttemptId()}.warc.gz"
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                page_id, url, sha1, size, refers_to, no, data = r
                if sink is None:
                    fs, root = _fs(out_dir)
                    fs.create_dir(root, recursive=True)
                    sink = fs.open_output_stream(f"{root}/{name}")
                if no == 0:
                    if member:
                        member.close()
                    member, n = Member(sink, level), n + 1
                    member.write(record_head(page_id, url, "response" if refers_to is None else "revisit", refers_to, size, sha1))
                member.write(data or b"")
        if sink is not None:
            member.close()
            sink.close()
            yield pa.RecordBatch.from_pylist([{"file": name, "n_records": n}])

    rows.mapInArrow(lean(write), MANIFEST).write.parquet(f"{out_dir}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{out_dir}/manifest")


def read_archives(spark: SparkSession, out_dir: str, chunk: int = 1 << 20, with_data: bool = True,
                  held: int = 1 << 22) -> DataFrame:
    """The chunk table of the archives: a row per record and chunk number,
    with the running digest of the payload.  ``with_data=False`` leaves the
    bytes out after digesting them."""
    importable(spark)
    files = [(f"{out_dir}/{r['file']}",) for r in spark.read.schema(MANIFEST).parquet(f"{out_dir}/manifest").collect()]
    kinds = pa.schema([(n, {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}[t])
                       for n, t in (x.split() for x in CHUNKS.split(", "))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                fs, path = _fs(uri)
                with fs.open_input_stream(path) as f:
                    rows, size = [], 0
                    for row in record_chunks(f, chunk):
                        size += 500 + len(row["data"]) * with_data
                        rows.append(row if with_data else row | {"data": None})
                        if size > held:
                            yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                            rows, size = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    table = spark.createDataFrame(files, "uri string").repartition(max(1, len(files)))
    return table.mapInArrow(lean(read), CHUNKS)


def records(chunks: DataFrame) -> DataFrame:
    """A row per record from its last chunk, which knows the whole length
    and digest: no grouping is needed."""
    end = F.col("offset") + F.col("n_bytes")
    return chunks.where("is_last").select(
        "page_id", F.when(F.col("stored"), end).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.col("sha1_so_far").alias("payload_digest"), "record_type", "refers_to")


def fresh_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "warc")
