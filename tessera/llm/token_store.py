"""Token ids in a compact file format, and back.

Format: Parquet rows, one a block. A block has whole documents in ascending
``doc_id`` order (column ``part``, then ``block``, is the order of all): their
ids, lengths, the Huffman bits of their ids, and the bit offset of every
``EVERY``-th id, so each block is read alone and each offset is an entry point.
The code is canonical (from code lengths alone, at most ``MAX_BITS`` bits, by
package-merge over the counts of all ids); the lengths are a table beside.

Reading looks ``MAX_BITS`` bits up in a table at all entry points of a block at
once, step by step.

Null and empty texts hold just the end id. Rows with a null ``doc_id`` come
first; rows that share an id (null too) are ordered by their first ``TIE``
characters, then by a hash of their ids, so that many such rows are dealt out to many tasks. An empty table gives
files without blocks and an empty result; further columns are not carried.
"""

from __future__ import annotations

import unicodedata
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, common

MAX_BITS = 18
EVERY = 128
TIE = 32
BLOCK_IDS = 1 << 18
SCHEMA = "part int, block int, n_docs int, n_ids long, doc_ids binary, known binary, lengths binary, bits binary, entries binary"


# --- ids of texts -----------------------------------------------------------

#: Words that go to the library in one text.
TOGETHER = 2000


def by_library(own: bpe.ChunkCodec, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words: many are encoded as one text by the library and told apart by their last tokens.

    A word that the library might take apart or change, or a text that gives
    another number of words, goes to the library's model word by word.
    """
    def plain(text: str) -> bool:
        return text.isascii() or (unicodedata.is_normalized("NFC", text) and text == bpe.folded(text) and not bpe.too_new(text))

    runs = [words[k : k + TOGETHER] for k in range(0, len(words), TOGETHER)]
    texts = [" ".join(run) for run in runs]
    parts, sizes = [], []
    for run, text, got in zip(runs, texts, own.library.encode_batch_fast(texts, add_special_tokens=False), strict=True):
        ids = np.array(got.ids, own.kind)
        ends = np.flatnonzero(own.last[ids]) + 1
        if len(ends) != len(run) or not plain(text):
            each = [np.array([t.id for t in own.library.model.tokenize(bpe.as_chars(w.encode()))], own.kind) for w in run]
            ids, ends = np.concatenate(each), np.cumsum([len(x) for x in each])
        parts.append(ids)
        sizes.append(np.diff(ends, prepend=0))
    return np.concatenate(parts), np.concatenate(sizes)


class Encoder(bpe.ChunkCodec):
    """The library's ids of texts; words not seen lately go to the library."""

    def __init__(self, source: bytes):
        super().__init__(source, by_library, 1_000_000, 64 << 20)
        #: Of each id: whether it ends a word.
        self.last = np.array([bool(self.bpe.end) and self.bpe.tokens.get(i, "").endswith(self.bpe.end) for i in range(max(self.bpe.tokens) + 1)], bool)


@lru_cache(maxsize=1)
def encoder(source: bytes) -> Encoder:
    return Encoder(source)


# --- the code ---------------------------------------------------------------


def code_lengths(counts: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Length of each symbol's code, 0 where it doesn't occur: the best code of at most ``most`` bits (package-merge)."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    n = len(used)
    if n == 0:
        return lengths
    if n == 1:
        lengths[used] = 1
        return lengths
    most = max(most, (n - 1).bit_length())
    used = used[np.argsort(counts[used], kind="stable")]
    own = counts[used].astype(np.int64)
    # Of each level only which items are packages is kept; the answer is read off from the last level down.
    packed, kinds = np.zeros(0, np.int64), []
    for _ in range(most):
        both = np.concatenate([own, packed])
        order = np.argsort(both, kind="stable")
        kinds.append(order >= n)
        both = both[order]
        packed = both[: len(both) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take = 2 * n - 2
    depth = np.zeros(n, np.int64)
    for kind in reversed(kinds):
        packages = int(kind[:take].sum())
        depth[: take - packages] += 1
        take = 2 * packages
    lengths[used] = depth
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then symbol."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    size = lengths[order].astype(np.uint64)
    if len(order):
        steps = np.uint64(1) << (np.uint64(63) - size)
        codes[order] = (np.cumsum(steps) - steps) >> (np.uint64(63) - size)
    return codes


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The ids' bits, highest first in 64-bit words, and the offset at which each id starts."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    starts = ends - size
    total = int(ends[-1]) if len(ends) else 0
    words = np.zeros(total // 64 + 2, np.uint64)
    code, word, bit = codes[ids], starts >> 6, starts & 63
    room = 64 - bit - size
    inside = room >= 0
    part = np.where(inside, code << np.where(inside, room, 0).astype(np.uint64), code >> np.where(inside, 0, -room).astype(np.uint64))
    if len(ids):
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        words[word[first]] = np.bitwise_or.reduceat(part, first)
        over = np.flatnonzero(~inside)
        words[word[over] + 1] |= code[over] << (64 + room[over]).astype(np.uint64)
    return words.astype(">u8").tobytes(), starts


@lru_cache(maxsize=1)
def decode_table(lengths: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """For the next bits: the symbol and how many bits are its own."""
    size = np.frombuffer(lengths, np.uint8)
    width = int(size.max(initial=1))
    codes = canonical(size)
    order = np.lexsort((np.arange(len(size)), size))
    order = order[size[order] > 0]
    spans = np.left_shift(1, width - size[order].astype(np.int64))
    symbol = np.zeros(1 << width, np.uint32)
    bits = np.zeros(1 << width, np.uint8)
    at = int(spans.sum())
    symbol[:at], bits[:at] = np.repeat(order, spans), np.repeat(size[order], spans)
    assert not len(order) or int(codes[order[0]]) == 0
    return symbol, bits, width


def unpack(bits: bytes, entries: np.ndarray, n: int, lengths: bytes) -> np.ndarray:
    """All ids of a block: every entry point goes forward one id at a time."""
    symbol, size, width = decode_table(lengths)
    words = np.frombuffer(bits, ">u8").astype(np.uint64)
    out = np.zeros((len(entries), EVERY), np.uint32)
    at = entries.astype(np.int64)
    for k in range(EVERY):
        if k and (len(entries) - 1) * EVERY + k >= n:
            at = at[: len(entries) - 1]  # the last entry's ids may end sooner
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        window = (words[word] << bit) | ((words[word + 1] >> np.uint64(1)) >> (np.uint64(63) - bit))
        found = window >> np.uint64(64 - width)
        out[: len(at), k] = symbol[found]
        at = at + size[found]
    return out.ravel()[:n]


# --- files ------------------------------------------------------------------


def write(docs: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2) -> None:
    """Write the ids of all texts, each with ``end_id`` after it, as ``path``/blocks and ``path``/code.

    Texts are encoded once, where they are read; their ids wait in ``path``/ids
    until the counts of all have given the code. Only ids are dealt out by ranges.
    """
    spark = docs.sparkSession
    with open(vocabulary, "rb") as f:
        source = spark.sparkContext.broadcast(f.read())
    text = common.col(text_col)
    rows = docs.select(text.alias("text"), common.col(id_col).cast("long").alias("doc_id"), F.substring(text, 1, TIE).alias("tie"))

    def encoded(batches):
        own = encoder(source.value)
        end = np.array([end_id], "<u4")
        for b in common.rows_of(batches, bpe.PIECE):
            ids = [np.concatenate([x, end]) for x in own.encode(b.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array([x.astype(own.kind if end_id < 1 << 8 * own.kind.itemsize else "<u4").tobytes() for x in ids], pa.binary()), pa.array([len(x) for x in ids], pa.int64())], ["doc_id", "tie", "ids", "n"])

    waiting_as = "doc_id long, tie string, ids binary, n long"
    rows.mapInArrow(encoded, waiting_as).write.option("compression", "zstd").parquet(f"{path}/ids")
    waiting = spark.read.schema(waiting_as).parquet(f"{path}/ids")

    def flat_ids(data: pa.Array, sizes: pa.Array) -> np.ndarray:
        """All ids of a batch; their width in bytes shows in the data."""
        offsets = np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + len(data) + 1]
        total = int(sizes.to_numpy().sum())
        size = int(offsets[-1] - offsets[0])
        return np.frombuffer(data.buffers()[2], f"<u{size // total}", total, int(offsets[0])) if total else np.zeros(0, np.uint32)

    def count(batches):
        total = np.zeros(1, np.int64)
        for b in batches:
            more = np.bincount(flat_ids(*b.columns), minlength=len(total))
            more[: len(total)] += total
            total = more
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["id", "n"])

    # At most one row for each id of the vocabulary comes to the driver.
    found = waiting.select("ids", "n").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(max(found["id"].to_pylist(), default=end_id) + 1, np.int64)
    counts[found["id"].to_numpy()] = found["n"].to_numpy()
    lengths = code_lengths(counts)
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").write.parquet(f"{path}/code")
    code = spark.sparkContext.broadcast(lengths.tobytes())

    def blocks(batches):
        size = np.frombuffer(code.value, np.uint8)
        codes, part, number = canonical(size), TaskContext.get().partitionId(), 0
        docs_of, sizes, ids, n = [], [], [], 0

        def done() -> pa.RecordBatch:
            doc = pa.concat_arrays(docs_of)
            bits, starts = pack(np.concatenate(ids).astype(np.int64), codes, size)
            row = [part, number, len(doc), n, doc.fill_null(0).to_numpy().astype("<i8").tobytes(), np.asarray(doc.is_valid(), np.uint8).tobytes(), np.concatenate(sizes).astype("<i8").tobytes(), bits, starts[::EVERY].astype("<u8").tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, [pa.int32(), pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5], strict=True)], [x.split()[0] for x in SCHEMA.split(", ")])

        for whole in batches:
            at = 0
            ends = np.cumsum(whole.column(3).to_numpy())
            while at < whole.num_rows:
                # Documents up to the one that fills the block.
                before = int(ends[at - 1]) if at else 0
                to = min(whole.num_rows, int(np.searchsorted(ends, before + BLOCK_IDS - n)) + 1)
                b = whole.slice(at, to - at)
                docs_of.append(b.column(0))
                sizes.append(b.column(3).to_numpy())
                ids.append(flat_ids(b.column(2), b.column(3)))
                n += int(ends[to - 1]) - before
                at = to
                if n >= BLOCK_IDS:
                    yield done()
                    docs_of, sizes, ids, n, number = [], [], [], 0, number + 1
        if n:
            yield done()

    width = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie").asc_nulls_first(), F.xxhash64("ids"), F.col("ids")]
    waiting.repartitionByRange(width, *order[:3]).sortWithinPartitions(*order).mapInArrow(blocks, SCHEMA).write.option("compression", "none").parquet(f"{path}/blocks")
    common.remove(spark, f"{path}/ids")


def read(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """Documents of the files: (doc_id, part, block, place, before, n_tokens, and ids array<int> or ids_crc32).

    ``before``: ids before the document in its block.
    """
    row = spark.read.schema("lengths binary").parquet(f"{path}/code").head()
    code = spark.sparkContext.broadcast(bytes(row.lengths) if row else b"")

    def run(batches):
        for batch in batches:
            for b in batch.to_pylist():
                ids = unpack(b["bits"], np.frombuffer(b["entries"], "<u8"), b["n_ids"], code.value)
                size = np.frombuffer(b["lengths"], "<i8")
                ends = np.cumsum(size)
                known = np.frombuffer(b["known"], np.uint8) == 0
                doc = pa.array(np.frombuffer(b["doc_ids"], "<i8"), mask=known)
                n = len(size)
                same = [pa.array(np.full(n, b[k], np.int32)) for k in ("part", "block")]
                if digest:
                    flat = ids.astype("<u4")
                    last = pa.array([zlib.crc32(flat[e - s : e]) for s, e in zip(size.tolist(), ends.tolist(), strict=True)], pa.int64())
                else:
                    last = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([doc, *same, pa.array(np.arange(n, dtype=np.int32)), pa.array(ends - size), pa.array(size), last], names)

    names = ["doc_id", "part", "block", "place", "before", "n_tokens", "ids_crc32" if digest else "ids"]
    kind = "ids_crc32 long" if digest else "ids array<int>"
    blocks = spark.read.schema(SCHEMA).parquet(f"{path}/blocks")
    return blocks.mapInArrow(run, f"doc_id long, part int, block int, place int, before long, n_tokens long, {kind}")


def starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, block, block_start): ids before each block, from the blocks' own sizes.

    Parts number as the write's partitions, which bounds the totals that meet in one task.
    """
    from pyspark.sql import Window as W

    sizes = spark.read.schema(SCHEMA).parquet(f"{path}/blocks").select("part", "block", "n_ids")
    totals = sizes.groupBy("part").agg(F.sum("n_ids").alias("total"))
    before = totals.select("part", (F.sum("total").over(W.orderBy("part")) - F.col("total")).alias("part_start"))
    inside = F.sum("n_ids").over(W.partitionBy("part").orderBy("block")) - F.col("n_ids")
    return sizes.withColumn("inside", inside).join(before, "part").select("part", "block", (F.col("part_start") + F.col("inside")).alias("block_start"))


def stored_digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2) -> DataFrame:
    """Write the store to the shared folder, read it back: (doc_id, start, n_tokens, ids_crc32)."""
    spark = docs.sparkSession
    path = common.fresh_path(spark, "token-store")
    write(docs, path, vocabulary, id_col, text_col, end_id)
    back = read(spark, path, digest=True)
    return back.join(starts(spark, path), ["part", "block"]).select("doc_id", (F.col("block_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
