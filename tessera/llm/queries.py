"""The thin queries op1 to op10 and the pipeline, with their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bpe_codec, common, exact_dedup, langid, licenses, lz_fingerprint, mixing, secret_scan, simhash, token_counts, token_store
from tessera.sources.ship import ship

BYTE_VOCABULARY = "byte_bpe_50k.json"
WORD_VOCABULARY = "word_bpe_49k.json"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(documents(spark, sf_dir), shingle=3, radius=2)


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(documents(spark, sf_dir)))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(documents(spark, sf_dir))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path(BYTE_VOCABULARY), limit=1024)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(documents(spark, sf_dir))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(documents(spark, sf_dir))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.stored_digests(documents(spark, sf_dir), public_tokenizers.path(WORD_VOCABULARY), end_id=2)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(documents(spark, sf_dir), common.fresh_path(spark, "ledger")))


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.digests(documents(spark, sf_dir), public_tokenizers.path(WORD_VOCABULARY))


def op10_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz_fingerprint.edited_likeness(documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": op1_simhash,
        "op2_licenses": op2_licenses,
        "op3_exact_dedup": op3_exact_dedup,
        "op4_token_counts": op4_token_counts,
        "op5_mixing": op5_mixing,
        "op6_language_id": op6_language_id,
        "op7_token_store": op7_token_store,
        "op8_secret_scan": op8_secret_scan,
        "op9_bpe_codec": op9_bpe_codec,
        "op10_lz_fingerprint": op10_lz_fingerprint,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_exact_dedup": exact_dedup.oracle(), "op5_mixing": mixing.oracle()}
