"""Writers and their self-checks."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F


def write_records(table: DataFrame, path: str) -> None:
    """The record table by status; rows without any candidate are written once more as 'unresolved'."""
    table.write.mode("overwrite").partitionBy("match_status").option("header", True).csv(f"{path}/records")
    table.where("candidate_count = 0").write.mode("overwrite").option("header", True).csv(f"{path}/unresolved")


def assert_coverage(rollup: DataFrame, s1: DataFrame, column: str) -> None:
    """Each entity exactly once, and no text that stands for nothing."""
    bad = rollup.groupBy("s1_id").count().where("count > 1").limit(1).count() + s1.select(F.col("id").alias("s1_id")).join(rollup, "s1_id", "left_anti").limit(1).count()
    bad += rollup.where(F.col(column).isNull() | F.lower(column).isin("none", "nan", "[]", "null")).limit(1).count()
    if bad:
        raise AssertionError(f"{column}: an entity is missing, repeated or has a stand-in value")


def write_tsv(rows: DataFrame, path: str, header: tuple[str, str]) -> None:
    """Two tab-separated columns, then read back: same header, same number of rows."""
    rows.toDF(*header).write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "").csv(path)
    back = rows.sparkSession.read.option("sep", "\t").option("header", True).csv(path)
    if tuple(back.columns) != header or back.count() != rows.count():
        raise AssertionError(f"{path}: not read back as written")


def write_report(spark: SparkSession, report: Row, path: str) -> None:
    """A one-row report as JSON; NaN becomes null."""
    clean = {k: None if isinstance(v, float) and v != v else v for k, v in report.asDict(recursive=True).items()}
    spark.createDataFrame([(json.dumps(clean, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_benchmark(table: DataFrame, scores: DataFrame, review: DataFrame, out: str) -> None:
    """The benchmark's three files: entities with their matches, scored pairs in order, and accepted pairs to look at."""
    table.write.mode("overwrite").option("header", True).csv(f"{out}/entity_matches")
    scores.orderBy("s1_id", "src", F.col("score").desc(), "id").write.mode("overwrite").option("header", True).csv(f"{out}/entity_pair_scores")
    review.write.mode("overwrite").option("header", True).csv(f"{out}/accepted_pairs_to_review")
