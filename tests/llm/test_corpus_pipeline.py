"""The stages one after another, and each on odd input."""

import corpus_pipeline


def test_stages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mixing", "bpe_encoding"]
    rows = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, "")
        assert rows.columns == docs.columns
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").columns == ["doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = corpus_pipeline.language_id(spark, docs, "")
    assert kept.count() == docs.where("text rlike '\\\\p{L}'").count()


def test_clashing_names_ties_and_long_texts(spark):
    """Extra columns by any name come through every stage as they were; repeated rows, ties and long texts too."""
    import random

    from pyspark.sql import functions as F

    rng = random.Random(11)
    long = " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(150_000))
    rows = [(1, "one small text of some words", "en", "a", 28), (1, "one small text of some words", "en", "a", 28), (2, "One small TEXT of some words", "en", "a", 28), (3, long, "en", "b", len(long)), (4, "\U000313a0\U000313a1", "zz", "b", 2), (None, "no id here at all", None, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    extra = ["score", "lang_pred", "a.b", "a`b", "__tessera_sha", "__tessera_id", "__tessera_text", "__tessera_carry_0", "__tessera_repeated", "keep_id", "kept", "node", "component", "size", "copies", "ids", "n_tokens", "held_out", "row", "text_sha256"]
    docs = docs.select("*", *(F.lit(k).alias(n) for k, n in enumerate(extra)))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns[5:] == extra, name
        got = docs.collect()
        assert all(list(r[5:]) == list(range(len(extra))) for r in got), name
        assert {r[0] for r in got} == {"language_id": {1, 2, 3, 4, None}, "exact_dedup": {2, 3, 4, None}, "near_dedup": {2, 3, 4, None}}.get(name, {r[0] for r in got})
        docs = spark.createDataFrame(got, docs.schema)
    assert corpus_pipeline.encode(spark, docs, "").count() == docs.count()


def test_empty_and_null_input(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for rows in ([], [(None, None, None, None, None), (1, "", None, None, 0)]):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, "").collect()
