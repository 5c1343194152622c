"""Readers. Every column of a delimited file is a string; nothing is inferred and "NA" stays text."""

from __future__ import annotations

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def load_config(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f)


def read_delimited(spark: SparkSession, path: str, sep: str = "\t", limit: int | None = None) -> DataFrame:
    """All columns as strings; the header names them. An absent file is an error."""
    out = spark.read.option("sep", sep).option("header", True).option("inferSchema", False).option("nullValue", "\u0000").option("emptyValue", "").option("multiLine", False).csv(path)
    out = out.toDF(*(c.strip() for c in out.columns))
    return out if limit is None else out.limit(limit)


def stream_delimited(spark: SparkSession, folder: str, columns: list[str], sep: str = "\t", files: int = 1) -> DataFrame:
    """The same as a stream of files."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.readStream.schema(schema).option("sep", sep).option("header", True).option("maxFilesPerTrigger", files).csv(folder)


def mapped(rows: DataFrame, src: int, id_col: str, fields: dict[str, str | None]) -> DataFrame:
    """(id, src, <field>...): a field whose source column is None or absent is missing throughout; the id column must exist."""
    if id_col not in rows.columns:
        raise KeyError(f"no id column {id_col!r} in {rows.columns}")
    picked = [(F.col(f"`{c}`") if c and c in rows.columns else F.lit(None)).cast("string").alias(f) for f, c in fields.items()]
    return rows.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.lit(src).cast("long").alias("src"), *picked)


def read_truth(spark: SparkSession, path: str, sep: str = "\t") -> tuple[DataFrame, DataFrame]:
    """(s1_id, ids array) with singletons, and its pairs (s1_id, id). The header is checked."""
    rows = read_delimited(spark, path, sep)
    if rows.columns != ["source1_entity_id", "matched_entity_ids"]:
        raise ValueError(f"unexpected header: {rows.columns}")
    ids = F.filter(F.transform(F.split(F.coalesce("matched_entity_ids", F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    whole = rows.select(F.col("source1_entity_id").alias("s1_id"), ids.alias("ids"))
    return whole, whole.select("s1_id", F.explode("ids").alias("id")).distinct()


def count_matches(rows: DataFrame, expected: int) -> DataFrame:
    """``rows``, after their number was checked."""
    found = rows.count()
    if found != expected:
        raise ValueError(f"{found} rows loaded, {expected} expected")
    return rows
