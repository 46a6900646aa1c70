"""Suffix-array deduplication: removes every byte that lies in a string of
``length`` bytes which also starts earlier in the corpus.

All strings (windows) of ``length`` bytes are suffixes cut to that length.
Sorting every one of them would shuffle a hundred times the corpus, so the
work is narrowed by steps that lose nothing, and the rest is a merge sort.

1. ``store``: documents are written into shards of bounded size.
2. Each window has an anchor: the position in it whose ``gram``-byte string
   has the smallest hash, a function of the window's bytes alone.  Windows in
   a row with the same anchor form a block.  Equal windows have equal anchor
   strings, so a block whose anchor string (its class) stands nowhere else
   holds no repeat.  Shards send the hashes of their classes to buckets,
   which answer which ones repeat (``classes``).
3. Shards sort their repeating blocks, one of each distinct text, and send
   front-coded sorted runs to the buckets of their classes (``runs``).
   Blocks of classes with very many texts are sent window by window, to the
   buckets of the windows, so that no class is a large group.
4. Buckets merge the runs with a loser tree over shared prefixes.  Neighbours
   that share all their bytes are the same string; neighbours that share the
   anchor string form a class, whose few block texts are compared window by
   window (``merged``).  The answer is a bit per window of the shard's first
   block of that text: does it also start earlier?
5. Shards cut their documents by the answers (``cut``).

A shard sends a string once however often it holds it, so no group grows with
the copies of a text.  Shards, and the places of their texts, are files in
the shared folder under names that hold the task attempt; every step is a
function of them and of rows that Spark shuffles, so a lost executor's tasks
are run again with the same result.
"""
from __future__ import annotations

import hashlib
import io
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path, shuffle_partitions
from .bit_planes import _fs
from .common import importable, lean, text_bytes, whole_text, written
from .suffix_runs import decode, front_code, merge

STRIP = 1 << 19          # windows that are anchored at once
INDEX = (1 << 20) - 1    # positions in a strip of windows and their bytes
NONE = -(1 << 63)        # the place of a null id: before all others
UNIQUE, REPEATED, CROWDED = 0, 1, 2


PLACES = {"row": np.int32, "start": np.int64, "windows": np.uint8, "u": np.uint32, "fresh": np.bool_}
NO_PLACES = {c: np.empty(0, k) for c, k in PLACES.items()}


# ------------------------------------------------------------------ blocks
def gram_hashes(t: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each ``k`` bytes in a row: a polynomial from one
    running sum, then mixed."""
    step, mod = 0x9E3779B97F4A7C15, 1 << 64
    n = len(t)
    up, down = np.full(n + 1, step, np.uint64), np.full(n + 1, pow(step, -1, mod), np.uint64)
    up[0] = down[0] = 1
    np.multiply.accumulate(up, out=up)
    np.multiply.accumulate(down, out=down)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((t.astype(np.uint64) + np.uint64(1)) * down[:n], out=total[1:])
    h = (total[k:] - total[:-k]) * up[k - 1:n]
    for shift, odd in ((31, 0xBF58476D1CE4E5B9), (29, 0x94D049BB133111EB)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(odd)
    return h ^ (h >> np.uint64(32))


def blocks(t: np.ndarray, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Per strip of a document: class hash, hash of the block's text, first
    window, number of windows and anchor of each block.  The strings at the
    first window, the anchor and the end cover the block's text."""
    reach = length - gram + 1
    for at in range(0, len(t) - length + 1, STRIP):
        h = gram_hashes(t[at:at + STRIP + length - 1], gram)
        low = (h & np.uint64(~INDEX & 0xFFFFFFFFFFFFFFFF)) | np.arange(len(h), dtype=np.uint64)
        span = 1
        while span * 2 <= reach:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < reach:
            low = np.minimum(low[:len(low) - (reach - span)], low[reach - span:])
        anchor = (low & np.uint64(INDEX)).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(anchor)) + 1])
        n = np.diff(np.append(first, len(anchor)))
        own = anchor[first]
        text = h[own]
        for x in (h[first], h[first + n - 1 + length - gram], (n << 8 | own - first).astype(np.uint64)):
            text = (text ^ x) * np.uint64(0xFF51AFD7ED558CCD)
            text ^= text >> np.uint64(32)
        yield h[own], text, at + first, n, at + own


class Shard:
    """A shard's documents and blocks.  Blocks are sorted by bucket, low half
    of the class hash and text hash, equal ones by document and place; so
    each class is a run of them, each text in it one too, and the first of a
    text is the earliest in the corpus order."""

    def __init__(self, table: pa.Table, length: int, gram: int, buckets: int):
        texts = table.column("text").combine_chunks()
        texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
        _, ends, data = texts.buffers()
        self.ends = np.frombuffer(ends, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        self.flat = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
        self.ids = table.column("id").fill_null(NONE).to_numpy()
        parts = []
        for row in np.argsort(self.ids, kind="stable").tolist():
            a, b = self.ends[row], self.ends[row + 1]
            if b - a >= length:
                parts += [(np.full(len(x[0]), row, np.int32), *x) for x in blocks(self.flat[a:b], length, gram)]
        kinds = (np.int32, np.uint64, np.uint64, np.int64, np.int64, np.int64)
        row, h, text, first, n, anchor = (np.concatenate(c) for c in zip(*parts, strict=True)) if parts else (np.empty(0, k) for k in kinds)
        bucket = ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        low = (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        by = np.lexsort((text, low, bucket))
        self.row, self.first, self.n, self.anchor, self.bucket = row[by], first[by], n[by], anchor[by], bucket[by]
        low, text = low[by], text[by]
        new = np.ones(len(by), bool)
        new[1:] = (low[1:] != low[:-1]) | (self.bucket[1:] != self.bucket[:-1])
        self.new_text = new.copy()
        self.new_text[1:] |= text[1:] != text[:-1]
        self.cls = np.cumsum(new) - 1                      # number of each block's class
        starts = np.flatnonzero(new)
        texts_in = np.add.reduceat(self.new_text, starts, dtype=np.int64) if len(starts) else starts
        again = np.diff(np.append(starts, len(by))) > 1
        #: per class: low half, number of texts (127 at most), whether it stands at several places
        self.low = low[starts]
        self.count = (np.minimum(texts_in, 127) * 2 + again).astype(np.uint8)
        self.cuts = np.searchsorted(self.bucket[starts], np.arange(buckets + 1))

    def same_text(self, i: np.ndarray, j: np.ndarray, length: int) -> np.ndarray:
        """Whether blocks i and j are equal, byte by byte."""
        same = (self.n[i] == self.n[j]) & (self.anchor[i] - self.first[i] == self.anchor[j] - self.first[j])
        if not len(i):
            return same
        a, b = self.ends[self.row[i]] + self.first[i], self.ends[self.row[j]] + self.first[j]
        size = self.n[i] - 1 + length
        if length < 8:
            words, step = self.flat, 1
        else:  # eight bytes at a time, the last eight overlapping those before
            words, step = np.ndarray((len(self.flat) - 7,), "<u8", self.flat.data, strides=(1,)), 8
        for k in range(0, int(size.max()), step):
            at = np.minimum(k, size - step)
            same &= words[a + at] == words[np.minimum(b + at, len(words) - 1)]
        return same


# ------------------------------------------------------------------- packs
def pack(**arrays: np.ndarray) -> bytes:
    import zstandard

    out = io.BytesIO()
    np.savez(out, **arrays)
    return zstandard.ZstdCompressor(level=1).compress(out.getvalue())


def unpack(data: bytes) -> dict[str, np.ndarray]:
    import zstandard

    with np.load(io.BytesIO(zstandard.ZstdDecompressor().decompress(data)), allow_pickle=False) as got:
        return dict(got)


def read_shard(uri: str) -> pa.Table:
    fs, path = _fs(uri)
    with fs.open_input_file(path) as f:
        return pq.read_table(f)


def put(uri: str, data: bytes) -> str:
    fs, path = _fs(uri)
    with fs.open_output_stream(path) as f:
        f.write(data)
    return uri


# --------------------------------------------------------------- operators
def store(docs: DataFrame, folder: str, id_col: str, text_col: str, keep: list[str], shard_bytes: int) -> DataFrame:
    """Write documents into shard files of about ``shard_bytes`` of text (a
    longer document is a shard of its own); returns a row per shard."""
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), whole_text(text_col).cast("binary").alias("text"),
                      *[F.col(c).alias(f"keep{i}") for i, c in enumerate(keep)])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx, held, size, no = TaskContext.get(), [], 0, 0
        fs, root = _fs(folder)
        fs.create_dir(root, recursive=True)

        def flush() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            uri = f"{folder}/shard-{ctx.partitionId():05d}-{no:05d}-{ctx.taskAttemptId()}.parquet"
            with fs.open_output_stream(_fs(uri)[1]) as f:
                pq.write_table(table, f, compression="zstd", use_dictionary=False, write_statistics=False)
            return pa.RecordBatch.from_pylist([{"shard": (ctx.partitionId() << 24) | no, "file": uri}])

        for batch in batches:
            sizes = text_bytes(batch.column("text")).to_pylist()
            start = 0
            for i, n in enumerate(sizes):
                if size and size + n > shard_bytes:
                    if i > start:
                        held.append(batch.slice(start, i - start))
                    yield flush()
                    held, size, no, start = [], 0, no + 1, i
                size += n + 16
            if len(sizes) > start:
                held.append(batch.slice(start))
        if held:
            yield flush()

    return written(src.mapInArrow(lean(write), "shard bigint, file string"), "shards")


def answer(lows: list[np.ndarray], counts: list[np.ndarray], crowd: int) -> list[np.ndarray]:
    """A code for each class hash that each shard sent."""
    value, inverse = np.unique(np.concatenate(lows), return_inverse=True)
    count = np.concatenate(counts)
    places = np.bincount(inverse, 1 + (count & 1), len(value))
    texts = np.bincount(inverse, count >> 1, len(value))
    full = np.bincount(inverse, count >> 1 == 127, len(value)) > 0   # may stand for any number
    code = np.where(full | (texts > crowd), CROWDED, REPEATED)
    code = np.where(places > 1, code, UNIQUE).astype(np.uint8)[inverse]
    ends = np.cumsum([0, *map(len, lows)])
    return [code[a:b] for a, b in zip(ends, ends[1:])]


def classes(shards: DataFrame, length: int, gram: int, buckets: int, crowd: int, tasks: int) -> DataFrame:
    """Per shard and bucket: a code for each class hash that the shard sent,
    in the order of sending."""
    sent_as = pa.schema([("bucket", pa.int32()), ("shard", pa.int64()), ("file", pa.string()), ("low", pa.binary()), ("count", pa.binary())])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, uri in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = Shard(read_shard(uri), length, gram, buckets)
                rows = [{"bucket": b, "shard": shard, "file": uri, "low": own.low[x:y].tobytes(), "count": own.count[x:y].tobytes()}
                        for b, (x, y) in enumerate(zip(own.cuts, own.cuts[1:])) if y > x or not b]  # at least one row per shard
                yield pa.RecordBatch.from_pylist(rows, schema=sent_as)

    def task(table: pa.Table) -> pa.Table:
        codes = answer([np.frombuffer(x.as_buffer(), np.uint32) for x in table.column("low")],
                       [np.frombuffer(x.as_buffer(), np.uint8) for x in table.column("count")], crowd)
        return pa.table({"shard": table.column("shard"), "file": table.column("file"), "bucket": table.column("bucket"),
                         "code": pa.array([c.tobytes() for c in codes], pa.binary())})

    return (shards.repartitionByRange(tasks, "shard")
            .mapInArrow(lean(send), "bucket int, shard bigint, file string, low binary, count binary")
            .groupBy("bucket").applyInArrow(lean(task), "shard bigint, file string, bucket int, code binary"))


def shard_runs(own: Shard, codes: np.ndarray, length: int, buckets: int) -> tuple[bytes, list[tuple[int, int, bytes]]]:
    """The runs of a shard as (kind, bucket, pack), and its own record of
    where each text stands.  Kind 0: blocks, as the bytes from the anchor on
    and then those before it; kind 1: single windows."""
    from xxhash import xxh64_intdigest

    code = codes[own.cls] if len(own.cls) else np.empty(0, np.uint8)
    picked = np.flatnonzero(code)
    # the first block of each one's text; a hash that lies makes a text of its own
    firsts = np.flatnonzero(own.new_text)
    first = firsts[np.cumsum(own.new_text)[picked] - 1] if len(picked) else picked
    first = np.where(own.same_text(picked, first, length), first, picked)
    fresh = first == picked
    alone = picked[fresh & (code[picked] == REPEATED)]     # one of each text that is sent as a block
    number = np.full(len(code), -1, np.int64)
    number[alone] = np.arange(len(alone))
    listed = code[picked] == REPEATED
    keep = listed | ~fresh                                 # crowded texts that come again: all windows seen
    at = [own.row[picked[keep]], own.first[picked[keep]], own.n[picked[keep]], np.maximum(number[first[keep]], 0), fresh[keep]]
    base = own.ends[own.row[alone]]
    mem, out = own.flat.data, []
    strings = [bytes(mem[a:e]) + bytes(mem[f:a]) for f, a, e in zip(
        (base + own.first[alone]).tolist(), (base + own.anchor[alone]).tolist(),
        (base + own.first[alone] + own.n[alone] - 1 + length).tolist(), strict=True)]

    def send(kind: int, to: int, entries: list[tuple[bytes, int]], **columns: np.ndarray) -> None:
        entries.sort()
        lcps, sizes, rests = front_code([x for x, _ in entries])
        i = np.array([k for _, k in entries], np.int64)
        out.append((kind, to, pack(lcp=lcps, size=sizes, rest=np.frombuffer(rests, np.uint8), u=i.astype(np.uint32),
                                   **{c: x[i] for c, x in columns.items()})))

    where = own.bucket[alone]                              # ascending, as blocks are sorted by it
    ends = np.searchsorted(where, np.arange(buckets + 1)).tolist()
    for b, (x, y) in enumerate(zip(ends, ends[1:])):
        if y > x:
            send(0, b, [(strings[k], k) for k in range(x, y)], before=(own.anchor - own.first)[alone].astype(np.uint8),
                 windows=own.n[alone].astype(np.uint8), id=own.ids[own.row[alone]], row=own.row[alone], start=own.first[alone])
    del strings
    # crowded texts, window by window, in document order
    crowded = picked[fresh & ~listed]
    crowded = crowded[np.lexsort((own.first[crowded], own.row[crowded], own.ids[own.row[crowded]]))]
    known: dict[bytes, int] = {}
    row, start, u, new = array("i"), array("q"), array("q"), array("b")
    lists: dict[int, list[tuple[bytes, int]]] = {}
    for r, f, w in zip(own.row[crowded].tolist(), own.first[crowded].tolist(), own.n[crowded].tolist(), strict=True):
        base = int(own.ends[r]) + f
        for k in range(w):
            window = bytes(mem[base + k:base + k + length])
            i = known.get(window)
            row.append(r)
            start.append(f + k)
            new.append(i is None)
            if i is None:
                i = known[window] = len(known)
                lists.setdefault(xxh64_intdigest(window) % buckets, []).append((window, len(u)))
            u.append(i + len(alone))
    row_, start_, u_ = np.array(row, np.int32), np.array(start, np.int64), np.array(u, np.int64)
    for b, entries in lists.items():
        entries.sort()
        lcps, sizes, rests = front_code([x for x, _ in entries])
        i = np.array([k for _, k in entries], np.int64)
        ones = np.ones(len(i), np.uint8)
        out.append((1, b, pack(lcp=lcps, size=sizes, rest=np.frombuffer(rests, np.uint8), u=u_[i].astype(np.uint32), before=ones * 0,
                               windows=ones, id=own.ids[row_[i]], row=row_[i], start=start_[i])))
    more = [row_, start_, np.ones(len(u_), np.int64), u_, np.array(new, bool)]
    record = pack(**{c: np.concatenate([x, y]).astype(k) for (c, k), x, y in zip(PLACES.items(), at, more, strict=True)})
    return record, out


def runs(answers: DataFrame, folder: str, length: int, gram: int, buckets: int, tasks: int) -> DataFrame:
    """The front-coded runs of every shard, a row per kind and bucket; each
    names the shard's file and the file with the places of its texts."""
    def make(key: tuple, table: pa.Table) -> pa.Table:
        shard, uri = key[0].as_py(), table.column("file")[0].as_py()
        codes = [np.empty(0, np.uint8)] * buckets
        for b, c in zip(table.column("bucket").to_pylist(), table.column("code"), strict=True):
            codes[b] = np.frombuffer(c.as_buffer(), np.uint8)
        record, made = shard_runs(Shard(read_shard(uri), length, gram, buckets), np.concatenate(codes), length, buckets)
        name = put(f"{folder}/places-{shard}-{TaskContext.get().taskAttemptId()}.bin", record) if made else ""
        return pa.table({"kind": pa.array([m[0] for m in made], pa.int32()), "bucket": pa.array([m[1] for m in made], pa.int32()),
                         "shard": pa.array([shard] * len(made), pa.int64()), "places": pa.array([name] * len(made), pa.string()),
                         "data": pa.array([m[2] for m in made], pa.binary())})

    # the rows are small and the work behind them isn't, so tasks are counted, not sized
    return answers.repartition(tasks, "shard").groupBy("shard").applyInArrow(
        lean(make), "kind int, bucket int, shard bigint, places string, data binary")


def resolve(group: list[tuple], length: int) -> Iterator[tuple[int, int, int]]:
    """(shard, text number, bits) for the texts of one class: a bit per
    window that also starts earlier.  ``group`` has per distinct text
    (text, windows, [(place, text number), ...]); a place is (id, shard, row,
    first window) of the text's first block in a shard."""
    firsts = [min(p for p, _ in own) for _, _, own in group]
    least: dict[bytes, tuple] = {}
    if len(group) > 1:
        for (text, windows, _), (id_, shard, row, start) in zip(group, firsts, strict=True):
            for j in range(windows):
                place = (id_, shard, row, start + j)
                window = text[j:j + length]
                if least.setdefault(window, place) > place:
                    least[window] = place
    for (text, windows, own), first in zip(group, firsts, strict=True):
        all_ = (1 << windows) - 1
        for place, u in own:
            bits = all_
            if place == first:
                id_, shard, row, start = place
                bits = sum((least[text[j:j + length]] != (id_, shard, row, start + j)) << j for j in range(windows)) if least else 0
            if bits:
                yield place[1], u, bits


def resolve_runs(kind: int, shards: list[int], packs: list[dict], length: int, gram: int) -> dict[int, list[tuple[int, int]]]:
    """Merge the runs of a bucket and resolve its classes: per shard the text
    numbers and bits."""
    feeds = [decode(p["lcp"], p["size"], p["rest"].tobytes()) for p in packs]
    own = [zip(*(p[c].tolist() for c in ("u", "before", "windows", "id", "row", "start")), strict=True) for p in packs]
    found: dict[int, list[tuple[int, int]]] = {}
    group: list[tuple] = []
    same = gram if kind == 0 else length   # bytes that the members of a class share
    last = None

    def close() -> None:
        if len(group) > 1 or group and len(group[0][2]) > 1:
            for shard, u, bits in resolve(group, length):
                found.setdefault(shard, []).append((u, bits))
        group.clear()

    for n, run, string in merge(feeds):
        u, before, windows, id_, row, start = next(own[run])
        place = ((id_, shards[run], row, start), u)
        if n == len(string) and last == (n, before, windows):
            group[-1][2].append(place)     # the same text from another shard
            continue
        if n < same:
            close()
        last = (len(string), before, windows)
        # back from (from the anchor on, before it) to the block's text
        text = string[len(string) - before:] + string[:len(string) - before] if before else string
        group.append((text, windows, [place]))
    close()
    return found


def merged(run_rows: DataFrame, length: int, gram: int, buckets: int) -> DataFrame:
    """Merge each bucket's runs; per shard, text numbers with the bits of
    windows that also start earlier.  A shard that sent a run gets a row from
    its bucket in any case, as its own repeats are in its places."""
    def task(key: tuple, table: pa.Table) -> pa.Table:
        places = dict(zip(table.column("shard").to_pylist(), table.column("places").to_pylist(), strict=True))
        found = resolve_runs(key[0].as_py(), table.column("shard").to_pylist(),
                             [unpack(x.as_buffer()) for x in table.column("data")], length, gram)
        rows = [found.get(s, []) for s in places]
        return pa.table({"shard": pa.array(list(places), pa.int64()), "places": pa.array(list(places.values()), pa.string()), "data": pa.array(
            [pack(u=np.array([u for u, _ in x], np.uint32), bits=np.array([b for _, b in x], np.uint64)) if x else b"" for x in rows],
            pa.binary())})

    return run_rows.repartition(buckets, "kind", "bucket").groupBy("kind", "bucket").applyInArrow(
        lean(task), "shard bigint, places string, data binary")


def removed_spans(size: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Maximal removed runs of a document as rows (start, end)."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, end, -1)
    gone = np.concatenate([[0], np.cumsum(change[:-1]) > 0, [0]]).astype(np.int8)
    edge = np.diff(gone)
    return np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], axis=1)


def cut_shard(table: pa.Table, places: dict[str, np.ndarray], bits: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, bytes]]:
    """Removed spans and remaining bytes per row of a shard.  ``bits`` by
    text number belong to the first place of the text; at its other places
    every window starts earlier."""
    row, start, windows = (places[c].astype(np.int64) for c in ("row", "start", "windows"))
    mask = np.where(places["fresh"] == 1, bits[places["u"]] if len(bits) else 0, (np.uint64(1) << windows.astype(np.uint64)) - np.uint64(1))
    hit = np.flatnonzero(mask)
    full = mask[hit] == (np.uint64(1) << windows[hit].astype(np.uint64)) - np.uint64(1)
    whole, some = hit[full], hit[~full]
    at = [(row[whole], start[whole], start[whole] + windows[whole] - 1 + length)]
    for j in range(int(windows[some].max()) if len(some) else 0):
        k = some[(mask[some] >> np.uint64(j)) & np.uint64(1) == 1]
        at.append((row[k], start[k] + j, start[k] + j + length))
    r, s, e = (np.concatenate(c) for c in zip(*at, strict=True))
    by = np.argsort(r, kind="stable")
    r, s, e = r[by], s[by], e[by]
    ends = np.searchsorted(r, np.arange(table.num_rows + 1))
    for i, text in enumerate(table.column("text")):
        data = text.as_buffer().to_pybytes()
        a, b = ends[i], ends[i + 1]
        if a == b:
            yield np.empty((0, 2), np.int64), data
            continue
        spans = removed_spans(len(data), s[a:b], e[a:b])
        keep, last = [], 0
        for x, y in spans.tolist():
            keep.append(data[last:x])
            last = y
        yield spans, b"".join([*keep, data[last:]])


def whole_characters(data: bytes, spans: np.ndarray) -> str:
    """Text that remains of ``data`` if ``spans`` shrink to whole characters:
    one that is partly in a span stays."""
    keep, last = [], 0
    for x, y in spans.tolist():
        while x < y and data[x] & 0xC0 == 0x80:
            x += 1
        while x < y < len(data) and data[y] & 0xC0 == 0x80:
            y -= 1
        keep.append(data[last:x])
        last = y
    return b"".join([*keep, data[last:]]).decode("utf-8", "ignore")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100,
                   keep: list[str] | None = None, with_text: bool = False, gram: int = 64,
                   shard_bytes: int = 8 << 20, crowd: int = 4096) -> DataFrame:
    """Per row: ``id_col``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal
    removed runs), ``kept_sha256``, the columns ``keep`` and, with
    ``with_text``, ``kept_text`` (the text without the removed runs, where a
    character that is partly in a run stays whole; the other columns count
    bytes).

    Texts are UTF-8 bytes, a null one is empty; matches don't cross
    documents.  A byte goes if a string of ``length`` bytes over it also
    starts at a smaller id, or earlier in the same row; overlaps count, and
    strings are judged on the input.  Rows with the same id are documents of
    their own, one of them the first; a null id comes before all others.
    ``gram`` (at most ``length``, at least half of it and less than 64 below
    it) and ``crowd`` (texts of a class, counted per shard, above which its
    windows are sorted singly) change the work, not the result.
    """
    if not max(length - 63, (length + 1) // 2) <= gram <= length or 2 * length - gram > 255:
        raise ValueError("gram must be at most length, at least half of it and less than 64 below it; blocks must fit front coding")
    spark = docs.sparkSession
    importable(spark)
    folder, keep, buckets = scratch_path(spark, "suffixes"), keep or [], 2 * shuffle_partitions(spark)
    shards = store(docs, folder, id_col, text_col, keep, shard_bytes)
    tasks = max(1, shards.count())
    made = runs(classes(shards, length, gram, buckets, crowd, tasks), folder, length, gram, buckets, tasks)
    verdicts = merged(made, length, gram, buckets).select("shard", F.lit("").alias("file"), "places", "data")
    parts = verdicts.unionByName(shards.select("shard", "file", F.lit("").alias("places"), F.lit(b"").alias("data")))
    kinds = [docs.schema[c].dataType.simpleString() for c in keep]
    schema = ["id bigint", "n_bytes bigint", "n_removed bigint", "n_spans bigint", "kept_sha256 string",
              *["kept_text string"] * with_text, *[f"keep{i} {k}" for i, k in enumerate(kinds)]]

    def cut(table: pa.Table) -> pa.Table:
        shard = read_shard(next(filter(None, table.column("file").to_pylist())))
        places = NO_PLACES
        if name := next(filter(None, table.column("places").to_pylist()), None):
            fs, path = _fs(name)
            with fs.open_input_stream(path) as f:
                places = unpack(f.read())
        bits = np.zeros(int(places["u"].max()) + 1 if len(places["u"]) else 0, np.uint64)
        for x in table.column("data"):
            if x.as_buffer().size:
                got = unpack(x.as_buffer())
                np.bitwise_or.at(bits, got["u"], got["bits"])
        n, gone, count, digest, text = [], [], [], [], []
        for (spans, data), whole in zip(cut_shard(shard, places, bits, length), shard.column("text"), strict=True):
            lost = int((spans[:, 1] - spans[:, 0]).sum())
            n.append(len(data) + lost)
            gone.append(lost)
            count.append(len(spans))
            digest.append(hashlib.sha256(data).hexdigest())
            if with_text:
                text.append(whole_characters(whole.as_buffer().to_pybytes(), spans))
        cols = {"id": shard.column("id"), "n_bytes": pa.array(n, pa.int64()), "n_removed": pa.array(gone, pa.int64()),
                "n_spans": pa.array(count, pa.int64()), "kept_sha256": pa.array(digest, pa.string())}
        if with_text:
            cols["kept_text"] = pa.array(text, pa.string())
        return pa.table(cols | {f"keep{i}": shard.column(f"keep{i}") for i in range(len(keep))})

    out = parts.repartition(tasks, "shard").groupBy("shard").applyInArrow(lean(cut), ", ".join(schema))
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256",
                      *["kept_text"] * with_text, *[F.col(f"keep{i}").alias(c) for i, c in enumerate(keep)])
