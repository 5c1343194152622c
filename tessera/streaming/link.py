"""Linkage of a stream of records against a static reference side: each micro-batch gives the rows that a batch run would."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import blocking as B
from tessera.operators import decide as D
from tessera.operators import features as X
from tessera.sources.staging import stage


def link_batch(s1: DataFrame, records: DataFrame, cfg: B.Blocking, decision: D.Decision) -> DataFrame:
    """The record table of raw records (id, src, name, address, country) against cleaned ``s1``."""
    others = stage(B.clean(records))
    found = B.capped(B.pairs(s1, others, cfg), cfg.cap)
    scored = X.composite(X.light_features(found, s1, others), groups=X.LIGHT_GROUPS).withColumn("score", F.round("weighted_composite_score", 6))
    return D.record_table(B.record_status(others, found), D.decisions(scored, decision))


def start(stream: DataFrame, s1: DataFrame, out: str, checkpoint: str, cfg: B.Blocking, decision: D.Decision):
    """Start the query; a batch that is retried replaces its own output."""

    def batch(rows: DataFrame, number: int) -> None:
        link_batch(s1, rows, cfg, decision).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, length: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events by window and type with a watermark; works on streams and on tables."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", length), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")
