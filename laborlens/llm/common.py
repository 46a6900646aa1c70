"""Helpers that several operators of this package share."""
from __future__ import annotations

import contextlib
import ctypes
import inspect
import os
from array import array
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver runs from."""
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if ROOT not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (have, ROOT) if x)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared scratch folder and read it back: the plan
    is cut, and a lost executor costs a re-read instead of a re-run."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on after its
    task, and what it holds counts against the executor's other work."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # no glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def lean(fn):
    """A task function for ``mapInArrow`` or ``applyInArrow`` that gives its
    memory back when it ends."""
    if inspect.isgeneratorfunction(fn):
        def run(batches):
            pa.set_memory_pool(pa.system_memory_pool())
            try:
                yield from fn(batches)
            finally:
                give_back()
        return run

    def by_key(key, table):
        try:
            return fn(key, table)
        finally:
            give_back()

    def whole(table):
        try:
            return fn(table)
        finally:
            give_back()

    return by_key if len(inspect.signature(fn).parameters) == 2 else whole


def whole_text(col: str | Column) -> Column:
    """A null text counts as the empty text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def text_bytes(texts: pa.Array) -> pa.Array:
    return pc.cast(pc.binary_length(texts), pa.int64())


def by_bytes(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose text column holds about ``limit`` bytes; one
    longer text is a slice of its own."""
    sizes = text_bytes(batch.column(column)).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, n in enumerate(sizes):
        if i > start and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if start < len(sizes):
        yield batch.slice(start)


def token_file(name: str) -> str:
    """A tokenizer file by its public name, or a path as it is."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return str(public_tokenizers.path(name))


class SegmentCache:
    """Results per distinct text segment, bounded by number of entries and
    by the length of what is kept; ``encode`` maps a list of segments to a
    list of results.  Kept per Python worker, so it spans tasks."""

    def __init__(self, encode, entries: int = 250_000, longest: int = 64):
        self.encode, self.entries, self.longest = encode, entries, longest
        self.known: dict = {}

    def lookup(self, segments: list) -> dict:
        """A mapping that holds a result for every one of ``segments``."""
        if len(self.known) > self.entries:
            self.known = {}
        new = list(set(segments).difference(self.known))
        if not new:
            return self.known
        found = dict(zip(new, self.encode(new), strict=True))
        short = {k: v for k, v in found.items() if len(k) <= self.longest}
        self.known.update(short)
        return self.known if len(short) == len(found) else {**self.known, **found}


# fixed values: the byte-level alphabet of public tokenizers, a printable character for each byte
PRINTED = {b: chr(b) for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
PRINTED |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in PRINTED)}


#: ASCII marks but the apostrophe (contractions) and < (added tokens).
MARKS = "!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"


def plain(letters: str) -> bool:
    """Whether these are Latin letters whose lower case is a letter each: the
    patterns of byte-level tokenizers never part them."""
    return letters.isalpha() and (letters.isascii() or max(letters) < "\u0130")


class Known(dict):
    """A dict that makes missing values; it is emptied at ``entries`` of them
    and keeps no key of over ``longest`` characters, so it stays bounded.
    Kept per Python worker, it spans tasks."""

    def __init__(self, make, entries: int = 150_000, longest: int = 64):
        super().__init__()
        self.make, self.entries, self.longest = make, entries, longest

    def __missing__(self, key: str):
        value = self.make(key)
        if len(self) >= self.entries:
            self.clear()
        if len(key) <= self.longest:
            self[key] = value
        return value


class Pretokens(Known):
    """Ids, as little-endian bytes, of what the merges of a byte-level
    tokenizer see as one string; from the library's own model."""

    def __init__(self, tokenizer, **bounds):
        tokenize = tokenizer.model.tokenize

        def make(text: str) -> bytes:
            return array("I", [t.id for t in tokenize(text.encode().decode("latin-1").translate(PRINTED))]).tobytes()

        super().__init__(make, **({"entries": 400_000} | bounds))
