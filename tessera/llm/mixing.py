"""Mixing sources to target weights, in DataFrame operations only.

Words are summed by source, targets set by weight with a ceiling, and each
source gets a repetition rate: a document is taken floor(rate) times, plus once
more if its seeded hash is below the source's threshold. The plain threshold,
the rate's fraction, leaves small sources with few long documents far from
their target; so the threshold is read off the sums of words by hash range:
the range end at which the words taken come nearest to the target. It tends to
the fraction as a source grows. No row is shuffled but to meet its source's
rate, and rates are broadcast if counted within the bound.

Edge cases: a null text has size 0; a null source is a source, ordered last; a
null id hashes as the empty text; repeated rows draw alike; all texts empty
gives targets of 0; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm import common

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CEILING = 2.0
SEED = "mix:"
#: Hash ranges a source's threshold can lie on: 2**12.
RANGE_BITS = 12


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def hash_range(doc_id: Column) -> Column:
    """The range, of 2**RANGE_BITS equal ones, that the document's seeded hash lies in."""
    digest = F.md5(F.concat(F.lit(SEED), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return F.shiftright(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), 32 - RANGE_BITS)


def rates(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, ceiling: float = CEILING) -> DataFrame:
    """(source, source_size, target, whole, until) by source, from rows (source, size, range).

    A document is taken ``whole`` times, and once more if its range is at most ``until``.
    """
    ranges = common.cut(sized.groupBy("source", "range").agg(F.sum("size").alias("size")), "ranges")
    # One row a source from here on; the windows without partition see only these.
    totals = ranges.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (place % len(weights) + 1).cast("int"))
    rows = totals.withColumn("weight", weight).withColumn("cap", F.lit(ceiling) * F.col("source_size"))
    filling = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rest = F.lit(share) * F.sum("source_size").over(everything) - (F.sum("cap").over(filling.rowsBetween(W.unboundedPreceding, 0)) - F.col("cap"))
    heavy = F.sum("weight").over(filling.rowsBetween(0, W.unboundedFollowing))
    rows = rows.withColumn("level", rest / heavy).withColumn("full", F.col("level") >= F.col("cap") / F.col("weight"))
    level = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    rows = rows.withColumn("target", F.when(F.col("full"), F.col("cap")).otherwise(level * F.col("weight")))
    rows = rows.withColumn("whole", F.when(F.col("source_size") == 0, F.lit(0)).otherwise(F.floor(F.col("target") / F.col("source_size"))).cast("long"))
    rows = rows.withColumn("more", F.col("target") - F.col("whole") * F.col("source_size")).select("source", "source_size", "target", "whole", "more")
    upto = F.sum("size").over(W.partitionBy("source").orderBy("range"))
    taken = ranges.withColumn("upto", upto)
    rows = common.cut(rows, "targets")
    near = taken.join(common.sized(rows, rows.count()), taken["source"].eqNullSafe(rows["source"])).select(taken["source"], "range", ((F.col("upto") + F.col("upto") - F.col("size")) <= 2 * F.col("more")).alias("near"))
    until = near.groupBy("source").agg(F.max(F.when(F.col("near"), F.col("range"))).alias("until"))
    out = rows.join(until, rows["source"].eqNullSafe(until["source"]), "left").select(rows["source"], "source_size", "target", "whole", F.coalesce("until", F.lit(-1)).alias("until"))
    return common.cut(out, "rates")


def copies(rows: DataFrame, source: str, found: DataFrame, in_range: Column) -> DataFrame:
    """``rows`` with their source's ``found`` columns (named private) and the number of copies to take."""
    names = {c: common.private(c) for c in found.columns}
    found = common.sized(found.withColumnsRenamed(names), found.count())
    both = rows.join(found, rows[source].eqNullSafe(found[names["source"]])).drop(names["source"])
    return both.withColumn(common.private("copies"), F.col(names["whole"]) + (in_range <= F.col(names["until"])).cast("long"))


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row."""
    sized = common.cut(docs.select(common.col(id_col).alias("doc_id"), common.col(source_col).alias("source"), words(common.col(text_col)).alias("size"), hash_range(common.col(id_col)).alias("range")), "sizes")
    out = copies(sized, "source", rates(sized), F.col("range"))
    return out.select("doc_id", "size", F.col(common.private("source_size")).alias("source_size"), F.col(common.private("target")).alias("target"), (F.col("size") * F.col(common.private("copies"))).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of the mix, each as often as it is taken, with the columns of ``docs``."""
    sized = docs.select(common.col(source_col).alias("source"), words(common.col(text_col)).alias("size"), hash_range(common.col(id_col)).alias("range"))
    out = copies(docs, source_col, rates(sized), hash_range(common.col(id_col)))
    again = F.explode(F.array_repeat(F.lit(0), F.col(common.private("copies")).cast("int")))
    return out.select(*(common.col(c) for c in docs.columns), again.alias(common.private("again"))).drop(common.private("again"))


def oracle() -> str:
    pick = " ".join(f"WHEN {k} THEN {float(w)}" for k, w in enumerate(WEIGHTS))
    return rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         (('0x' || substr(md5('{SEED}' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT >> {32 - RANGE_BITS}) AS r
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} {pick} END::DOUBLE AS weight,
         {CEILING}::DOUBLE * source_size AS cap FROM s),
l AS (
  SELECT *, ({SHARE}::DOUBLE * sum(source_size) OVER ()
             - (sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING) - cap))
            / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (
  SELECT source, source_size, CASE WHEN level >= cap / weight THEN cap
         ELSE max(CASE WHEN level < cap / weight THEN level END) OVER () * weight END AS target FROM l),
c AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size)::BIGINT END AS whole FROM t),
b AS (SELECT source, r, sum(size)::BIGINT AS size FROM d GROUP BY source, r),
u AS (SELECT source, r, size, (sum(size) OVER (PARTITION BY source ORDER BY r))::BIGINT AS upto FROM b),
x AS (
  SELECT u.source, max(u.r) AS until FROM u JOIN c ON u.source IS NOT DISTINCT FROM c.source
  WHERE 2 * u.upto - u.size <= 2 * (c.target - c.whole * c.source_size) GROUP BY u.source)
SELECT d.doc_id, d.size, c.source_size, c.target, d.size * (c.whole + CASE WHEN d.r <= coalesce(x.until, -1) THEN 1 ELSE 0 END) AS taken
FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source LEFT JOIN x ON d.source IS NOT DISTINCT FROM x.source"""
