"""BPE encoding and decoding of whole texts: speculate, verify, repair.

White-space-free chunks are kept per worker in a table of bounded size
(:class:`tessera.llm.bpe.ChunkCodec`). The words of chunks not seen lately are
encoded together by :meth:`tessera.llm.bpe.WordBpe.encode_words`: greedy
proposals, one vectorised check of all adjacent pairs, exact merging of the words
that fail it. A chunk with a character newer than the pattern library's tables
sends its text to the tokenizers library, as word limits may lie elsewhere there.
Decoding reads the tokens of the ids from a table and joins them.

Null and empty texts have no ids and decode to the empty text; repeated rows
stay; an empty table gives an empty result. ``carry`` names further columns that
stay beside the ids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import bpe, common

#: Ids turned into text at once.
SLICE = 1 << 20


def speculated(own: bpe.ChunkCodec, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    found = own.bpe.encode_words([bpe.as_chars(w.encode()) for w in words])
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter((i for ids in found for i in ids), own.kind, int(sizes.sum())), sizes


class Codec(bpe.ChunkCodec):
    """Encoder and decoder with one word vocabulary."""

    def __init__(self, source: bytes):
        super().__init__(source, speculated, entries=300_000, most=24 << 20)
        size = max(self.bpe.tokens) + 1
        self.tokens = pa.array([self.bpe.tokens.get(i, "") for i in range(size)], pa.large_string())
        self.numbers = pa.array(list(map(str, range(size))), pa.large_string())

    def shown(self, table: pa.Array, ids: list[np.ndarray]) -> list[bytes]:
        """Of each run of ids: their entries in ``table`` joined by one space, in UTF-8."""
        ends = np.r_[0, np.cumsum([len(x) for x in ids], dtype=np.int64)]
        lists = pa.LargeListArray.from_arrays(pa.array(ends), table.take(pa.array(np.concatenate(ids) if ids else np.zeros(0, self.kind))))
        return pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.large_binary()).to_pylist()

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The text of each run of ids, special tokens kept."""
        return self.shown(self.tokens, ids)

    def digests(self, ids: list[np.ndarray]) -> Iterator[tuple[str, str]]:
        """SHA-256 of the decimal ids and of the decoded text; runs over ``SLICE`` ids are taken in slices."""
        for at, size in grouped([len(x) for x in ids], SLICE):
            part = ids[at : at + size]
            if size == 1 and len(part[0]) > SLICE:
                both = [hashlib.sha256(), hashlib.sha256()]
                for k in range(0, len(part[0]), SLICE):
                    for h, table in zip(both, (self.numbers, self.tokens), strict=True):
                        h.update((b" " if k else b"") + self.shown(table, [part[0][k : k + SLICE]])[0])
                yield both[0].hexdigest(), both[1].hexdigest()
            else:
                for a, b in zip(self.shown(self.numbers, part), self.decode(part), strict=True):
                    yield hashlib.sha256(a).hexdigest(), hashlib.sha256(b).hexdigest()


def grouped(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs (start, length) of items whose sizes add up to at most ``most``; a larger item is a run of its own."""
    at = total = 0
    for k, n in enumerate(sizes):
        if k > at and total + n > most:
            yield at, k - at
            at, total = k, 0
        total += n
    if at < len(sizes):
        yield at, len(sizes) - at


@lru_cache(maxsize=1)
def codec(source: bytes) -> Codec:
    return Codec(source)


def _rows(docs: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...]) -> tuple[DataFrame, str]:
    """Text first, then the id and the carried columns, and the schema of all but the text."""
    rows = docs.select(common.col(text_col).alias(common.private("text")), common.col(id_col).alias("doc_id"), *map(common.col, carry))
    return rows, "".join(f"{common.quoted(f.name)} {f.dataType.simpleString()}, " for f in rows.schema.fields[1:])


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *carry, n_tokens, ids array<int>, decoded) of every row."""
    with open(vocabulary, "rb") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        own = codec(source.value)
        for b in common.rows_of(batches, 1_000_000):
            ids = own.encode(b.column(0).to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32)), pa.array(np.concatenate(ids).astype(np.int32)))
            texts = pa.array(own.decode(ids), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array([len(x) for x in ids], pa.int64()), lists, texts], [*b.schema.names[1:], "n_tokens", "ids", "decoded"])

    rows, kinds = _rows(docs, id_col, text_col, carry)
    return rows.mapInArrow(common.tidied(run), f"{kinds}n_tokens long, ids array<int>, decoded string")


def digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *carry, n_tokens, ids_sha256, decoded_sha256) of every row, made where the ids are made."""
    with open(vocabulary, "rb") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        own = codec(source.value)
        for b in common.rows_of(batches):
            ids = own.encode(b.column(0).to_pylist())
            both = list(own.digests(ids))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[1:], pa.array([len(x) for x in ids], pa.int64()), *(pa.array([x[k] for x in both], pa.string()) for k in (0, 1))], [*b.schema.names[1:], "n_tokens", "ids_sha256", "decoded_sha256"]
            )

    rows, kinds = _rows(docs, id_col, text_col, carry)
    return rows.mapInArrow(common.tidied(run), f"{kinds}n_tokens long, ids_sha256 string, decoded_sha256 string")


def decode(rows: DataFrame, vocabulary: str, ids_col: str = "ids", carry: tuple[str, ...] = ()) -> DataFrame:
    """(*carry, decoded) of every row, from its ids alone; null ids decode to the empty text."""
    with open(vocabulary, "rb") as f:
        source = rows.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        own = codec(source.value)
        for b in common.rows_of(batches):
            ids = [np.array(x or [], own.kind) for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(own.decode(ids), pa.binary()).cast(pa.string())], [*b.schema.names[1:], "decoded"])

    held = rows.select(common.col(ids_col).alias(common.private("ids")), *map(common.col, carry))
    kinds = "".join(f"{common.quoted(f.name)} {f.dataType.simpleString()}, " for f in held.schema.fields[1:])
    return held.mapInArrow(common.tidied(run), f"{kinds}decoded string")
