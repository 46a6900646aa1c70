"""Token counts: batch encoding in Arrow functions that return lengths only.

Each Arrow batch is cut into slices of about ``batch_bytes`` of text.  A text
is cut where no piece of the vocabulary can span the cut (safe boundaries),
the distinct segments of a slice are encoded in one call, and only their
lengths are added up.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SegmentCache, by_bytes, importable, lean, text_bytes, token_file, whole_text

SPACE = "▁"  # fixed value: how the sentencepiece library writes a space
# from one run of spaces to before the next: the model treats both characters alike
LONG = 1 << 20  # characters
UNIT = re.compile(f"[ {SPACE}]+[^ {SPACE}]*")


class PieceLengths:
    """Lengths of sentencepiece encodings, by safe segments.

    The model puts one space before a text, and its pieces are found by
    merges that only ever build pieces of the vocabulary.  If no piece has a
    space after another character, no merge crosses from a character to a
    following space, so each unit (spaces, then other characters) is encoded
    on its own; its first space is left to the library, which adds it back.
    A vocabulary without that property, or a normaliser that rewrites
    spaces, gets whole texts.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        plain = self.model.encode("a  b", out_type=str)
        self.safe = (not any(SPACE in p.lstrip(SPACE) for p in pieces)
                     and "".join(plain) == f"{SPACE}a{SPACE}{SPACE}b")
        self.cache = SegmentCache(self._encode)
        self.one_space = len(self.model.encode("a ")) - len(self.model.encode("a"))

    def _encode(self, segments: list[str]) -> list[int]:
        # an empty segment is a text's last, single space
        return [len(ids) if s else self.one_space
                for s, ids in zip(segments, self.model.encode(segments, num_threads=1), strict=True)]

    def counts(self, texts: list[str]) -> list[int]:
        if not self.safe:
            return [len(x) for x in self.model.encode(texts, num_threads=1)]
        if len(texts) == 1 and len(texts[0]) > LONG:
            return [self._long(texts[0])]
        units = [[u[1:] for u in UNIT.findall(" " + t)] if t else [] for t in texts]
        known = self.cache.lookup([u for us in units for u in us])
        return [sum(map(known.__getitem__, us)) for us in units]

    def _long(self, text: str) -> int:
        """The units of a long text are taken some at a time."""
        units, total = (m[0][1:] for m in UNIT.finditer(" " + text)), 0
        while some := list(islice(units, 1 << 16)):
            total += sum(map(self.cache.lookup(some).__getitem__, some))
        return total


@lru_cache(maxsize=4)
def piece_lengths(path: str) -> PieceLengths:
    return PieceLengths(path)


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 model: str = "piece_bpe_32k.model", limit: int = 4096,
                 batch_bytes: int = 1 << 20) -> DataFrame:
    """Per row: ``id_col``, ``n_bytes``, ``n_tokens``, ``over_limit``.

    Whole texts, without begin, end or added tokens.  A null text is empty
    and has no tokens; repeated rows give repeated results; other columns of
    ``docs`` are neither read nor returned; an empty table gives none.  A
    long text is held with some of its units at a time, a unit between
    spaces as a whole.
    """
    importable(docs.sparkSession)

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_lengths(token_file(model))
        for batch in batches:
            for part in by_bytes(batch, "text", batch_bytes):
                n = encoder.counts(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), text_bytes(part.column("text")), pa.array(n, pa.int64())],
                    names=["id", "n_bytes", "n_tokens"])

    src = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    out = src.mapInArrow(lean(lengths), f"id {kind}, n_bytes bigint, n_tokens bigint")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                      (F.col("n_tokens") > limit).alias("over_limit"))
