"""Business records derived from the test tables; the same SQL text serves Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Records of three sources from ``part``, with noise that depends on the key alone.
RECORDS = """
SELECT p_partkey AS k, p_partkey % 3 AS src,
  concat(CASE p_partkey % 3 WHEN 0 THEN 'S1-' WHEN 1 THEN 'S2-' ELSE 'S3-' END, p_partkey) AS id,
  CASE WHEN p_partkey % 7 = 0 THEN 'N/A' WHEN p_partkey % 5 = 0 THEN concat(p_name, ' Co., LLC')
       WHEN p_partkey % 5 = 1 THEN concat('The ', p_name, ' Shop') WHEN p_partkey % 5 = 2 THEN concat(p_name, ' dba Other')
       WHEN p_partkey % 5 = 3 THEN upper(p_name) ELSE p_name END AS name,
  CASE WHEN p_partkey % 11 = 0 THEN '-' WHEN p_partkey % 13 = 0 THEN concat('Near City Hall, ', p_type, ' Survey, Bengaluru, Karnataka 560001')
       ELSE concat(p_size, ' N Main St, ', CASE p_size % 4 WHEN 0 THEN 'Springfield, IL' WHEN 1 THEN 'Salt Lake City, UT' WHEN 2 THEN 'Austin, TX' ELSE 'New York, NY' END,
                   ' ', 10000 + p_partkey % 89) END AS address,
  p_brand AS country,
  CASE p_partkey % 4 WHEN 0 THEN concat('(217) 555-', 1000 + p_partkey % 900) WHEN 1 THEN concat('1-217-555-', 1000 + p_partkey % 900)
       WHEN 2 THEN concat('555-', 1000 + p_partkey % 900) ELSE 'none' END AS phone,
  CASE p_partkey % 3 WHEN 0 THEN concat(60000 + p_partkey % 50, '-1234') WHEN 1 THEN concat('', 60000 + p_partkey % 50) ELSE '274' END AS zip,
  CASE p_partkey % 5 WHEN 0 THEN 'Illinois' WHEN 1 THEN 'il' WHEN 2 THEN 'New York' WHEN 3 THEN 'Ontario' ELSE 'TX' END AS state,
  CASE p_partkey % 6 WHEN 0 THEN 'Restaurants' WHEN 1 THEN 'Eating Places' WHEN 2 THEN 'Auto Repair Shops' WHEN 3 THEN 'Coffee & Tea Shops'
       WHEN 4 THEN 'Widget Factories' ELSE 'n/a' END AS category,
  CAST(30 + (p_partkey % 40) / 8.0 AS double) AS lat, CAST(-90 - (p_partkey % 60) / 4.0 AS double) AS lon,
  lower(p_name) AS true_name, p_type AS true_type
FROM part
"""

#: Records whose texts have accents and several lines: the whole texts of documents.
LINES = """
SELECT doc_id, text AS line, lang, source FROM documents
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RECORDS.replace("FROM part", "FROM {part}"), part=table(spark, sf_dir, "part"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LINES.replace("FROM documents", "FROM {documents}"), documents=table(spark, sf_dir, "documents"))
