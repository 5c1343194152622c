"""Lempel-Ziv phrase fingerprints.

A text is cut into words (longer ones into pieces of ``PIECE`` bytes) and parsed
into phrases: the longest phrase met before plus one word makes a new phrase.
Each phrase is known by a 64-bit rolling hash; the fingerprint is the
``SKETCH`` smallest of the scrambled hashes (32 bits each) of the phrase set.
Likeness of two fingerprints: the share of the union's smallest that both have,
which estimates (and for small sets is) the sets' Jaccard similarity.

Edge cases: null and empty texts have the empty fingerprint; two empty ones
have likeness 1, an empty one and another 0. Rows that repeat a ``doc_id`` are
ordered by text; null ids come last, ordered by the hash of the text and then the
text, and are dealt out by that hash. A table of one row has itself next.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import common

SKETCH = 64
PIECE = 16
MASK = (1 << 64) - 1
MULTIPLIER = 0x9E3779B97F4A7C15


class Parser:
    def __init__(self, limit: int = 300_000):
        self.known: dict[bytes, int] = {}
        self.limit = limit

    def word(self, w: bytes) -> int:
        if len(self.known) >= self.limit:
            self.known.clear()
        h = self.known[w] = xxhash.xxh64_intdigest(w) | 1
        return h

    def phrases(self, text: bytes) -> set[int]:
        """Hashes of the phrases of a text; the last, met before, is among them already."""
        known, new = self.known, self.word
        seen: set[int] = set()
        add, at = seen.add, 0
        for w in text.split():
            for p in (w,) if len(w) <= PIECE else [w[i : i + PIECE] for i in range(0, len(w), PIECE)]:
                at = (at * MULTIPLIER + (known.get(p) or new(p))) & MASK
                if at not in seen:
                    add(at)
                    at = 0
        return seen

    def fingerprint(self, text: bytes) -> np.ndarray:
        phrases = self.phrases(text)
        h = np.fromiter(phrases, np.uint64, len(phrases))
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        h = np.unique(((h ^ (h >> np.uint64(33))) >> np.uint64(32)).astype(np.uint32))
        return h[:SKETCH]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)
    # A sketch shorter than SKETCH is the whole set.
    size = SKETCH if max(len(a), len(b)) == SKETCH else len(union)
    union = union[:size]
    return float((np.isin(union, a) & np.isin(union, b)).sum() / len(union))


def shown(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row, without a shuffle."""

    def run(batches):
        own = Parser()
        for b in common.rows_of(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shown(own.fingerprint(t or b"")) for t in b.column(1).to_pylist()], pa.string())], ["doc_id", "fingerprint"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (range, doc_id, text, lead) dealt by ranges of doc_id and sorted so that each row's next row follows it.

    The next row is the one with the next smaller id, the first row after the
    last. Each range also gets the first row of the next one (``lead``).
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.when(F.col("doc_id").isNull(), F.xxhash64("text")))
    ranges = 2 * max(16, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ids = rows.select("doc_id").where("doc_id IS NOT NULL")
    total, known = rows.agg(F.count("*"), F.count("doc_id")).head()
    cuts = sorted(set(ids.approxQuantile("doc_id", [k / ranges for k in range(1, ranges)], 0.5 / ranges))) if known else []
    # Ranges count up as ids go down; null ids have the last ones, as many as their share of the rows, by hash.
    unnamed = max(1, -(-ranges * (total - known) // max(1, total)))
    at = F.floor((F.col("tie") / F.lit(2.0**64) + F.lit(0.5)) * F.lit(unnamed))
    place = F.lit(len(cuts) + 1) + F.coalesce(F.least(F.lit(unnamed - 1), at), F.lit(0))
    if cuts:
        bounds = F.array(*(F.lit(float(c)) for c in cuts))
        place = F.when(F.col("doc_id").isNull(), place).otherwise(F.size(F.filter(bounds, lambda c: c > F.col("doc_id"))))
    rows = rows.withColumn("range", place.cast("int"))
    # At most one row for each range comes to the driver.
    firsts = rows.groupBy("range").agg(F.max("doc_id").alias("first")).orderBy("range").collect()
    if not firsts:
        return rows.select("range", "doc_id", "text", F.lit(False).alias("lead"))
    before = {firsts[(k + 1) % len(firsts)].range: r.range for k, r in enumerate(firsts)}
    table = F.create_map(*(x for a, b in before.items() for x in (F.lit(a), F.lit(b))))
    tops = F.create_map(*(x for r in firsts for x in (F.lit(r.range), F.lit(r.first).cast("long"))))
    heads = rows.where(F.col("doc_id").eqNullSafe(tops[F.col("range")]))
    # Of rows that share the first id the one with the smallest text leads.
    heads = heads.groupBy("range", "doc_id").agg(F.min(F.struct("tie", "text")).alias("least")).select(table[F.col("range")].alias("range"), "doc_id", "least.text", "least.tie")
    both = rows.withColumn("lead", F.lit(False)).unionByName(heads.withColumn("lead", F.lit(True)))
    return both.repartition(F.col("range")).sortWithinPartitions("range", "lead", F.col("doc_id").desc_nulls_last(), "tie", "text").select("range", "doc_id", "text", "lead")


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches):
        own = Parser()

        def rows() -> Iterator[tuple]:
            for b in common.rows_of(batches):
                yield from zip(*(c.to_pylist() for c in b.columns), strict=True)

        held, out, size = None, [], 0
        for at, doc, text, lead in rows():
            print_of = own.fingerprint(text.encode())
            if held is not None and held[0] == at:
                _, old, own_text, old_print = held
                n = len(own_text)
                edited = own_text[: n - n // 2] + text[: n // 2]
                data = edited.encode()
                changed = own.fingerprint(data)
                out.append((old, n, hashlib.sha256(data).hexdigest(), shown(old_print), shown(changed), likeness(old_print, changed), likeness(old_print, print_of)))
                if len(out) >= 2000:
                    yield as_batch(out)
                    out = []
            held = None if lead else (at, doc, text, print_of)
        if out:
            yield as_batch(out)

    def as_batch(out):
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return with_next(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
