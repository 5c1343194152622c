"""Secret scan over an incremental ledger of blobs.

A text version is a blob, addressed by the SHA-256 of its UTF-8 bytes. The
ledger, a Parquet folder, holds the findings of every blob and rule version
scanned so far, clean ones included. A scan takes addresses of all rows, scans
only blobs that the ledger lacks for the rule version, each once, adds them,
and joins findings back to every row by address.

A broadcast filter of bounded size (:class:`tessera.llm.exact_dedup.Filter`)
tells rows whose blob is certainly met once and new: they are scanned where
they are. A second one tells rows that may stand for a new blob; no other text
moves, so texts that the ledger knows stay where they are. The ledger is cut into
folders by address; only those of the rows' addresses are read.

Edge cases: a null text is the empty blob; rows that repeat id and text share
findings; an empty table adds nothing and gives an empty result.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common, exact_dedup

RULES_VERSION = "1"

# Base rules.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
BASE = ("assign", "access", "hex")

#: Further rules: kind, a string that every match has, pattern.
MORE = (
    ("pem", "-----BEGIN ", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    ("jwt", "eyJ", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    ("github", "gh", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    ("slack", "xox", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    ("url", "://", r"://[^/\s:@]+:[^/\s:@]+@"),
)
KINDS = (*BASE, *(k for k, _, _ in MORE))

_ASSIGN = re.compile(ASSIGN, re.ASCII)
_KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(ACCESS)
_LONG_HEX = re.compile(r"[0-9a-f]{32,}")
_MORE = tuple((k, hint, re.compile(p)) for k, hint, p in MORE)

FINDING = "array<struct<kind:string,start:long,end:long>>"


def find(text: str) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) in code points, by start, then kind as listed."""
    out: list[tuple[str, int, int]] = []
    low = text.lower() if text.isascii() else None
    # Without a key word there is no assignment; texts beyond ASCII go straight to the pattern, as lower() may change them.
    if low is None or any(k in low for k in _KEYWORDS):
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    # A run of hex digits is one match as a whole, so the runs of 32 and more are the matches that stay.
    out += [("hex", m.start(), m.end()) for m in _LONG_HEX.finditer(text)]
    for kind, hint, pattern in _MORE:
        if hint in text:
            out += [(kind, m.start(), m.end()) for m in pattern.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SHA = common.private("blob")


def _scan(blobs: DataFrame) -> DataFrame:
    """(blob, findings) of rows (blob, text)."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for b in common.rows_of(batches):
            found = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in find(t)] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, kind)], ["blob", "findings"])

    return blobs.select(F.col(SHA).alias("blob"), "text").mapInArrow(run, f"blob string, findings {FINDING}")


def shard(blob: Column) -> Column:
    """The folder of the ledger that an address lies in: its first hex digit."""
    return F.substring(blob, 1, 1)


def read_ledger(spark: SparkSession, ledger: str, version: str = RULES_VERSION, shards: list[str] | None = None) -> DataFrame:
    """(blob, findings, shard) of a rule version, one row a blob however often it was added; empty where the ledger has none.

    Given ``shards``, only their folders are read.
    """
    folder = f"{ledger}/rules={version}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    schema = f"blob string, findings {FINDING}, shard string"
    if not there:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(folder)
    return (rows if shards is None else rows.where(F.col("shard").isin(shards))).dropDuplicates(["blob"])


def scan(docs: DataFrame, ledger: str, id_col: str = "doc_id", text_col: str = "text", version: str = RULES_VERSION) -> DataFrame:
    """(doc_id, blob, findings) of every row; blobs new to the ledger are scanned and added first.

    Which rows are to be scanned is decided on ids and addresses alone. Rows that
    are certainly new and the only ones of their blob are scanned where they are;
    of other texts only those that stand for a new blob may move.
    """
    spark = docs.sparkSession
    text = F.coalesce(common.col(text_col), F.lit(""))
    rows = docs.select(common.col(id_col).alias("doc_id"), text.alias("text"), F.sha2(text.cast("binary"), 256).alias(SHA))
    paths = common.cut(rows.select("doc_id", SHA), "addresses")
    # At most 16 shards; only those that these rows' addresses lie in are read.
    shards = [r[0] for r in paths.select(shard(F.col(SHA))).distinct().collect()]
    known = read_ledger(spark, ledger, version, shards).select(F.col("blob").alias(SHA))
    known = common.cut(known, "known")
    # A known blob counts twice, so its rows are never taken for new ones.
    repeated = exact_dedup.Filter(paths.select(SHA).unionAll(known).unionAll(known), (SHA,), 2)
    flagged = repeated.flagged(paths).where(exact_dedup.FLAG)
    stands = flagged.groupBy(SHA).agg(F.min("doc_id").alias("doc_id")).join(known, SHA, "left_anti")
    stands = common.cut(stands.select("doc_id", SHA), "stand-ins")
    chosen = exact_dedup.Filter(stands, ("doc_id", SHA), 1)
    both = repeated.flagged(rows)
    alone = both.where(~F.col(exact_dedup.FLAG))
    some = common.sized(stands.select(F.col("doc_id").alias("stands"), F.col(SHA).alias("sha")), stands.count())
    moved = chosen.flagged(both.where(exact_dedup.FLAG).drop(exact_dedup.FLAG)).where(exact_dedup.FLAG)
    first = moved.join(some, (F.col(SHA) == F.col("sha")) & F.col("doc_id").eqNullSafe(F.col("stands")))
    # Rows that repeat both id and text would be scanned more than once; the ledger keeps one.
    scanned = _scan(alone.select(SHA, "text")).unionByName(_scan(first.select(SHA, "text")).dropDuplicates(["blob"]))
    scanned.withColumn("shard", shard(F.col("blob"))).hint("rebalance", "shard").write.mode("append").partitionBy("shard").parquet(f"{ledger}/rules={version}")
    done = read_ledger(spark, ledger, version, shards)
    return paths.withColumnRenamed(SHA, "blob").join(done, "blob").select("doc_id", "blob", "findings")


def digest(found: DataFrame) -> DataFrame:
    """The flat columns of the scan: counts by base kind, digest of base spans, all spans."""

    def count(kind: str):
        return F.size(F.filter("findings", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def shown(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("findings", lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *map(count, BASE), F.sha2(shown(base).cast("binary"), 256).alias("base_sha256"), shown(F.col("findings")).alias("spans"))
