"""Exact duplicates by two passes over a Bloom filter, in DataFrame operations only.

First pass: every text's hash names one cell; cells hit twice or more are kept as
bitmaps of 32,768 cells. Second pass: a row whose cell is kept may be repeated and
goes to the exact grouping; any other row is the only one of its text and passes
without a shuffle.

The bitmaps are broadcast, so a filter has at most ``CELLS`` cells (32 MB). With
more rows than that serves, hashes are cut into slices, each with a filter of its
own. The filters of all slices are built in one job; the second pass then looks
at one slice after the other. Nothing else changes with size.

What shuffles in the first pass is one 8-byte cell a row, after partial counts.
Partial bitmaps would be more: each task would send a whole filter, while a task's
rows touch a small part of it.

Edge cases: a null text counts as empty. A null id is smaller than any other;
in a group with only null ids every row stays. Rows that repeat both id and text
are one document: all get the same marks. Empty tables give empty results.
Further columns may have any names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import common

BLOCK = 32_768
CELLS = 1 << 28
CELLS_A_ROW = 16

SHA = common.private("sha")
FLAG = common.private("repeated")
ID = common.private("id")


def text_sha(col: Column) -> Column:
    """Lower-case hex SHA-256 of the text with A-Z in lower case."""
    return F.sha2(common.lower_ascii(col).cast("binary"), 256)


class Filter:
    """Cells that at least ``least`` of the rows of ``keys`` (columns ``key``) hit, by slices of the hash."""

    def __init__(self, keys: DataFrame, key: tuple[str, ...], least: int):
        rows = keys.count()
        self.key = key
        self.slices = max(1, -(-rows * CELLS_A_ROW // CELLS))
        cells = BLOCK
        while cells < min(CELLS, -(-rows * CELLS_A_ROW // self.slices)):
            cells *= 2
        self.cells = cells
        # One job for all slices: each slice's cells come after those of the one before.
        hit = keys.select(self.place()[1].alias("cell")).groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") >= least)
        bits = hit.groupBy(F.shiftright("cell", 15).alias("block")).agg(F.expr(f"bitmap_construct_agg(cell & {BLOCK - 1})").alias("bits"))
        self.bits = common.cut(bits, "bloom")

    def place(self) -> tuple[Column, Column]:
        """The slice and the cell of a row."""
        h = F.xxhash64(*self.key)
        slice_ = F.pmod(h, F.lit(self.slices)).cast("long")
        cell = F.shiftrightunsigned(h, 24).bitwiseAND(self.cells - 1)
        return slice_, cell if self.slices == 1 else slice_ * F.lit(self.cells) + cell

    def flagged(self, rows: DataFrame, flag: str = FLAG) -> DataFrame:
        """``rows`` with a boolean column: true wherever a row's cell is kept."""
        at, data, place = (common.private(x) for x in ("block", "bits", "cell"))
        slice_, cell = self.place()
        byte = F.conv(F.hex(F.substring(data, F.shiftright(F.col(place).bitwiseAND(BLOCK - 1), 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        hit = F.getbit(byte, F.col(place).bitwiseAND(7).cast("int")) == 1
        parts = []
        blocks = self.cells // BLOCK
        for k in range(self.slices):
            bits = self.bits.where((F.col("block") >= k * blocks) & (F.col("block") < (k + 1) * blocks)) if self.slices > 1 else self.bits
            part = rows.where(slice_ == k) if self.slices > 1 else rows
            part = part.withColumn(place, cell).withColumn(at, F.shiftright(place, 15))
            part = part.join(F.broadcast(bits.select(F.col("block").alias(at), F.col("bits").alias(data))), at, "left")
            parts.append(part.withColumn(flag, F.coalesce(hit, F.lit(False))).drop(at, data, place))
        return reduce(DataFrame.unionByName, parts)


def mark(rows: DataFrame, id_col: str, keys: DataFrame | None = None) -> DataFrame:
    """``rows`` (with column ``SHA``) plus keep_id, group_size, kept and ``FLAG``.

    ``keys``: the same rows' id and ``SHA`` alone, written, if ``rows`` carry more.
    """
    keys = rows if keys is None else keys
    repeated = Filter(keys, (SHA,), 2)
    groups = repeated.flagged(keys.select(id_col, SHA)).where(FLAG).groupBy(SHA).agg(F.max(id_col).alias("keep_id"), F.count("*").alias("group_size")).where("group_size > 1")
    groups = common.cut(groups, "groups")
    both = repeated.flagged(rows)
    alone = both.where(~F.col(FLAG)).withColumn("keep_id", F.col(id_col)).withColumn("group_size", F.lit(1).cast("long"))
    maybe = both.where(FLAG).join(common.sized(groups, groups.count()), SHA, "left")
    maybe = maybe.withColumn("keep_id", F.when(F.col("group_size").isNull(), F.col(id_col)).otherwise(F.col("keep_id"))).withColumn("group_size", F.coalesce("group_size", F.lit(1).cast("long")))
    return alone.unionByName(maybe).withColumn("kept", F.col(id_col).eqNullSafe(F.col("keep_id")))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and digest of every row, written to the shared folder."""
    return common.cut(docs.select(common.col(id_col).alias("doc_id"), text_sha(common.col(text_col)).alias(SHA)), "digests")


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row; the row with the largest id of equal texts stays."""
    return mark(digests(docs, id_col, text_col), "doc_id").select("doc_id", "keep_id", "group_size", "kept", F.col(SHA).alias("text_sha256"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one for each text, with the columns they came with."""
    keys = digests(docs, id_col, text_col).withColumnRenamed("doc_id", ID)
    # All columns go by private names, whatever they are called.
    own = {c: common.private(f"own_{k}") for k, c in enumerate(docs.columns)}
    rows = docs.select(*(common.col(c).alias(x) for c, x in own.items()), common.col(id_col).alias(ID), text_sha(common.col(text_col)).alias(SHA))
    marked = mark(rows, ID, keys).where("kept")
    whole = marked.where(F.col("group_size") > 1).dropDuplicates([SHA])
    out = marked.where(F.col("group_size") == 1).unionByName(whole)
    return out.select(*(F.col(x).alias(c) for c, x in own.items()))


def oracle() -> str:
    upper, lower = common.ASCII_UPPER, common.ASCII_UPPER.lower()
    return f"""
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{upper}', '{lower}')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM d"""
