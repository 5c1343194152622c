"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints are sorted by Gray rank; runs of sixteen share a node that keeps
the bits on which all of them agree (mask and value). Two nodes whose agreed
bits differ in more places than allowed are dropped with all below them.

Across the cluster a fingerprint goes to the groups that agree with it on one
of three thirds of its bits: two fingerprints with at most two differing bits
agree on a third. A group with too many different fingerprints is split again
by thirds of the bits that are left, three times at most; what then remains of
a group has at most 2**19 members.

Edge cases: a null text counts as empty and has fingerprint zero; rows without
``doc_id`` take part with a null id (a component of only such rows has a null
id); repeated rows stay. An empty table gives an empty result. Further columns
of the input are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import common

FAN = 16
CHUNK = 4096
PIECE = 4 << 20
WHITE = b" \t\n\x0b\x0c\r"

# --- fingerprints -----------------------------------------------------------


def word_runs(text: bytes, k: int) -> Iterator[list[bytes]]:
    """The words of a text in runs of bounded length, each run starting with the last k-1 words of the one before."""
    if len(text) <= PIECE:
        yield text.split()
        return
    carry: list[bytes] = []
    at, rest = 0, b""
    while at < len(text):
        piece = rest + text[at : at + PIECE]
        at += PIECE
        if at < len(text):
            end = max(piece.rfind(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")) + 1
            piece, rest = piece[:end], piece[end:]
        words = piece.split()
        if words:
            yield carry + words
            carry = (carry + words)[-(k - 1) :] if k > 1 else []


def shingle_hashes(text: bytes | None, k: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every k-word shingle of the text with A-Z in lower case; of all words if there are fewer."""
    parts: list[np.ndarray] = []
    short: list[bytes] = []
    digest = xxhash.xxh64_intdigest
    for words in word_runs((text or b"").lower(), k):
        n = len(words) - k + 1
        if n > 0:
            joined = map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False))
            parts.append(np.fromiter((digest(x, seed) for x in joined), np.uint64, n))
        else:
            short = words
    if not parts and short:
        parts.append(np.array([digest(b" ".join(short), seed)], np.uint64))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the 64-bit values have each bit set, lowest bit first."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(h), 255 * 256):
        part = h[at : at + 255 * 256]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(part) // 255 * 255
        lanes = bits.view(np.uint64)
        if whole:
            total += lanes[:whole].reshape(-1, 255, 8).sum(axis=1, dtype=np.uint64).view(np.uint8).sum(axis=0, dtype=np.int64)
        if whole < len(part):
            total += lanes[whole:].sum(axis=0, dtype=np.uint64).view(np.uint8).astype(np.int64)
    return total


def majority(h: np.ndarray) -> int:
    """The fingerprint of shingle hashes: a bit is one if set in over half of them."""
    if not len(h):
        return 0
    return int(np.packbits(2 * bit_counts(h) > len(h), bitorder="little").view(np.uint64)[0])


def mixed(h: np.ndarray, salt: int) -> np.ndarray:
    """A further 64-bit hash of each hash."""
    x = h + np.uint64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp long) of every row."""

    def run(batches):
        for b in batches:
            fps = [majority(shingle_hashes(t.as_py(), shingle)) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, "doc_id long, fp long")


# --- the index --------------------------------------------------------------


def near_pairs(codes: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Index pairs i < j of rows of ``codes`` (n x words, in Gray order) that differ in at most ``radius`` bits, with the number."""
    n = len(codes)
    if n < 2:
        return
    ands, ors = [codes], [codes]
    while len(ands[-1]) > 2 * FAN:
        starts = np.arange(0, len(ands[-1]), FAN)
        ands.append(np.bitwise_and.reduceat(ands[-1], starts, axis=0))
        ors.append(np.bitwise_or.reduceat(ors[-1], starts, axis=0))
    masks = [~(a ^ o) for a, o in zip(ands, ors, strict=True)]
    i, j = np.triu_indices(len(ands[-1]))
    stack = [(len(ands) - 1, i, j)]
    while stack:
        level, i, j = stack.pop()
        if len(i) > CHUNK * FAN * FAN:
            half = len(i) // 2
            stack += [(level, i[half:], j[half:]), (level, i[:half], j[:half])]
            continue
        value, mask = ands[level], masks[level]
        apart = np.bitwise_count((value[i] ^ value[j]) & (mask[i] & mask[j])).sum(axis=1, dtype=np.int64)
        keep = apart <= radius
        if level == 0:
            keep &= i < j
            if keep.any():
                yield i[keep], j[keep], apart[keep]
            continue
        i, j = i[keep], j[keep]
        below = len(ands[level - 1])
        a, b = np.divmod(np.arange(FAN * FAN), FAN)
        for at in range(0, len(i), CHUNK):
            x = (i[at : at + CHUNK, None] * FAN + a).ravel()
            y = (j[at : at + CHUNK, None] * FAN + b).ravel()
            ok = (x < below) & (y < below) & (x <= y)
            stack.append((level - 1, x[ok], y[ok]))


def thirds(mask: int) -> list[int]:
    """``mask`` with each third of the bits that it lacks."""
    left = [b for b in range(64) if not mask >> b & 1]
    n = len(left)
    cuts = [0, n // 3, 2 * n // 3, n]
    return [mask | sum(1 << b for b in left[cuts[k] : cuts[k + 1]]) for k in range(3)]


def signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def gray_rank(col):
    """Place of a code in Gray order, as a signed long in the order of the unsigned one."""
    for shift in (1, 2, 4, 8, 16, 32):
        col = col.bitwiseXOR(F.shiftrightunsigned(col, shift))
    return col.bitwiseXOR(F.lit(-(2**63)))


def groups_of(batches: Iterator, keys: int, limit: int | None) -> Iterator[list[np.ndarray]]:
    """Runs of rows with equal first ``keys`` columns; a run over ``limit`` rows is passed over, held at most that long."""
    held: list[list[np.ndarray]] = []
    count, over = 0, False
    last = None

    def done():
        return [np.concatenate(x) for x in zip(*held, strict=True)] if held and not over else None

    for b in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        n = b.num_rows
        if not n:
            continue
        new = np.zeros(n, bool)
        for c in cols[:keys]:
            new[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(new).tolist(), n]
        for s, e in zip(starts[:-1], starts[1:], strict=True):
            key = tuple(int(c[s]) for c in cols[:keys])
            if key != last:
                if (run := done()) is not None:
                    yield run
                held, count, over, last = [], 0, False, key
            count += e - s
            if limit is not None and count > limit:
                held, over = [], True
            if not over:
                held.append([c[s:e] for c in cols[keys:]])
    if (run := done()) is not None:
        yield run


def link_groups(rows: DataFrame, radius: int, limit: int | None) -> DataFrame:
    """A spanning forest of the links inside every group: (a, b) fingerprints, fewer than the members."""

    def run(batches):
        out_a, out_b, n = [], [], 0
        for (codes,) in groups_of(batches, 2, limit):
            if len(codes) < 2:
                continue
            labels = np.arange(len(codes))
            for i, j, _ in near_pairs(codes.view(np.uint64)[:, None], radius):
                labels = common.union_pairs(labels, i, j)
            child = np.flatnonzero(labels != np.arange(len(codes)))
            if len(child):
                out_a.append(codes[child])
                out_b.append(codes[labels[child]])
                n += len(child)
            if n >= 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], ["a", "b"])
                out_a, out_b, n = [], [], 0
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], ["a", "b"])

    dealt = rows.repartition("mask", "value").sortWithinPartitions("mask", "value", "rank")
    return dealt.select("mask", "value", "fp").mapInArrow(run, "a long, b long")


def link_fingerprints(distinct: DataFrame, radius: int = 2, limit: int = 2048) -> DataFrame:
    """Links (a, b) that connect exactly the distinct fingerprints (column fp) that chains of at most ``radius`` <= 2 bits connect.

    ``limit``: groups with more members are split by further bits instead of
    being searched in one task.
    """
    if not 0 <= radius <= 2:
        raise ValueError("three bands cover at most two differing bits")
    level, links = [0], []
    base = distinct.select("fp")
    rows = None
    for depth in range(3):
        masks = [m for old in level for m in thirds(old)]
        if depth == 0:
            rows = base.select("fp", F.explode(F.array(*(F.lit(signed(m)) for m in masks))).alias("mask"))
        else:
            table = F.create_map(*(x for old in level for x in (F.lit(signed(old)), F.array(*(F.lit(signed(m)) for m in thirds(old))))))
            rows = rows.select("fp", F.explode(table[F.col("mask")]).alias("mask"))
        rows = rows.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp", gray_rank(F.col("fp")).alias("rank"))
        last = depth == 2
        links.append(link_groups(rows, radius, None if last else limit))
        if last:
            break
        hot = common.cut(rows.groupBy("mask", "value").count().where(F.col("count") > limit).select("mask", "value"), "hot-bands")
        n = hot.count()
        if not n:
            break
        rows = rows.join(common.sized(hot, n), ["mask", "value"], "left_semi")
        level = masks
    out = links[0]
    for more in links[1:]:
        out = out.union(more)
    return out


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2, limit: int = 2048) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; component_id: the smallest doc_id that links reach."""
    fps = common.cut(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = common.cut(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    classes = common.cut(common.connected_components(link_fingerprints(distinct, radius, limit)), "components")
    members = common.cut(distinct.join(classes.withColumnRenamed("node", "fp"), "fp"), "members")
    tops = common.cut(members.groupBy("component").agg(F.min("first").alias("component_id")), "tops")
    named = members.join(tops, "component").select("fp", "component_id")
    by_fp = common.cut(distinct.join(named, "fp", "left").select("fp", F.coalesce("component_id", "first").alias("component_id")), "by-fingerprint")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return fps.join(by_fp, "fp").select("doc_id", hexed, "component_id")
