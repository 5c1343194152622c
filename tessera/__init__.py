"""Spark-first record linkage and data quality."""
