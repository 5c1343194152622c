"""The corpus pipeline: language ID, exact and near deduplication, mixing, BPE encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``. Each stage works on all rows the one before
kept, whatever its size. Nulls, empty texts, repeated rows, empty tables and
further columns are handled as the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe_codec, common, exact_dedup, langid, mixing, near_dup
from tessera.sources.ship import ship


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found go on; those without one (null, or no letter) are rejected.

    The model is learned from all labelled rows; ``lang`` itself is left as it came.
    """
    ship(spark)
    model = langid.learn(docs.select("text", "lang"))
    predicted = common.private("lang_pred")
    found = langid.predict(docs, model, carry=tuple(docs.columns), lang_col=predicted, score_col=common.private("lang_score"))
    return found.where(F.col(predicted) != langid.UNKNOWN).select(*map(common.col, docs.columns))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z the row with the largest doc_id stays."""
    return exact_dedup.deduplicated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 0.8 or more of five-word shingles stays: the one with the smallest doc_id."""
    ship(spark)
    return near_dup.deduplicated(docs, shingle=5, threshold=0.8)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids_sha256, decoded_sha256) of every row of the mix, by BPE encoding and decoding."""
    ship(spark)
    return bpe_codec.digests(docs, public_tokenizers.path("word_bpe_49k.json"), carry=("source",))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates),
    ("mixing", mix),
    ("bpe_encoding", encode),
]

#: The learned, iterative and tokenising stages have no SQL; tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = common.cut(docs, f"stage-{name}")
    return docs
