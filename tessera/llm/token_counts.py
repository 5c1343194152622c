"""Token counts by byte-pair merging, without token ids.

A text is split by the vocabulary's pattern; of each piece the bytes are the
first symbols, a heap holds the adjacent pairs by rank, a linked list the
symbols that are left. The lowest pair is merged again and again; the piece
counts its initial symbols minus its merges. What a piece counts is kept per
worker, so a frequent one is merged once.

Null and empty texts count 0 bytes and 0 tokens; repeated rows stay; an empty
table gives an empty result; further columns are not carried.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import bpe, common

CACHE = 400_000
#: White space next to white space, or other than a space or line feed: such texts aren't cut at spaces first.
UNEVEN = regex.compile(rf"[{bpe.SPACE}][{bpe.SPACE}]|(?![ \n])[{bpe.SPACE}]")


class Counter:
    """Counts tokens of texts with one vocabulary."""

    def __init__(self, source: bytes):
        self.bpe = bpe.WordBpe(source)
        self.cache = bpe.Cache(CACHE)

    def piece(self, text: str) -> int:
        symbols = [self.bpe.byte_id[x] for x in text.encode()]
        return len(symbols) - bpe.merges_done(symbols, self.bpe.ranks)

    def pieces(self, text: str) -> int:
        return sum(map(self.piece, bpe.FIND_BYTES.findall(text)))

    def learn(self, keys) -> None:
        for k in self.cache.lacking(keys):
            self.cache[k] = self.pieces(k)

    def keys(self, text: str) -> list[str]:
        """Stretches that the pattern never joins: from each single space or line feed to the next."""
        if text[:1] in " \n" or text[-1:] in " \n" or UNEVEN.search(text):
            return bpe.FIND_BYTES.findall(text)
        head, *rest = text.replace("\n", " \n").split(" ")
        return [head, *[x if x[0] == "\n" else " " + x for x in rest]]

    def count(self, texts: list[str | None]) -> list[int]:
        keyed, extra = [], []
        for t in texts:
            keys, specials = [], 0
            for part, special in self.bpe.parts(t or ""):
                if special is not None:
                    specials += 1
                elif part:
                    keys += self.keys(part)
            keyed.append(keys)
            extra.append(specials)
        self.cache.turn()
        self.learn(k for keys in keyed for k in keys)
        get = self.cache.__getitem__
        return [n + sum(map(get, keys)) for keys, n in zip(keyed, extra, strict=True)]


@lru_cache(maxsize=2)
def counter(source: bytes) -> Counter:
    return Counter(source)


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row; ``vocabulary``: path of a byte-level BPE file, read on the driver."""
    with open(vocabulary, "rb") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        own = counter(source.value)
        for b in common.rows_of(batches):
            texts = b.column(1).to_pylist()
            sizes = [len(t.encode()) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(own.count(texts), pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    out = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = out.schema["doc_id"].dataType.simpleString()
    return out.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
