"""Tables that a plan reads more than once: written to the folder that the cluster shares, then read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only where none is set and all run on one machine."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if not found and not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
    found = found or getattr(context, "_tessera_stage", None)
    if not found:
        found = context._tessera_stage = f"file://{tempfile.mkdtemp(prefix='tessera-')}"
    return found.rstrip("/")


def stage(rows: DataFrame) -> DataFrame:
    """``rows``, computed once and read back; lineage ends there, so a lost executor costs little."""
    path = f"{shared_folder(rows.sparkSession)}/stage-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def spread(rows: DataFrame) -> DataFrame:
    """A scan with fewer splits than the cluster has cores, dealt out to all of them; any other as it is."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows
