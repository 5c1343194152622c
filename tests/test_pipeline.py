"""The linkage pipeline end to end on generated records."""

from tessera.operators import blocking as B
from tessera.plans import benchmark, pipeline
from tessera.sources import synth
from tessera.sources.staging import stage


def test_validate_then_predict(spark, tmp_path):
    records, truth = map(stage, synth.generate(spark, 150, 7))
    run = pipeline.Run(B.Blocking(df_ratio=0.2, max_bucket=200), rounds=5)
    out = pipeline.link(spark, records, truth, f"{tmp_path}/model", f"{tmp_path}/out", run)
    assert out["report"]["f05_macro"] > 0.6
    assert out["rollup"].count() == records.where("src = 0").count()
    assert out["records"].count() == records.where("src > 0").count()
    assert spark.read.option("sep", "\t").option("header", True).csv(f"{tmp_path}/out/matching_results").count() == 150
    again = pipeline.link(spark, records, None, f"{tmp_path}/model", None, run)
    assert again["records"].count() == out["records"].count()


def test_benchmark(spark, tmp_path):
    out = benchmark.run(spark, 150, 7, benchmark.Benchmark(rounds=5, oracle=True), out=f"{tmp_path}/out")
    assert out["report"]["features"] == 59
    assert out["report"]["f05_macro"] > 0.6 and out["report"]["recall_ceiling"] > 0.7
    assert out["table"].count() == 150 and spark.read.option("header", True).csv(f"{tmp_path}/out/entity_pair_scores").count() == out["report"]["candidates"]
    silver = benchmark.run(spark, 150, 7, benchmark.Benchmark(rounds=5, margin=0.2, target_precision=0.9))
    assert silver["accepted"].count() > 0 and {r.src for r in silver["summary"].collect()} == {1, 2}


def test_generator_is_reproducible(spark):
    a, b = (sorted(map(str, synth.generate(spark, 60, 3)[0].repartition(n).collect())) for n in (1, 5))
    assert a == b


def test_benchmark_pairs_where_sides_meet(spark):
    """Pairs and all 59 features as the joins of pairs by id give them, without a shuffle of pairs."""
    from pyspark.sql import functions as F

    from tessera.operators import blocking as B
    from tessera.operators import features as X
    from tessera.sources import synth
    from tessera.sources.staging import stage

    rows = stage(benchmark.weighed(stage(benchmark.prepared(stage(synth.generate(spark, 400, 7, traps=True)[0])))))
    s1, others = rows.where("src = 0"), rows.where("src > 0")
    words = B.token_df(s1).where("df <= 30")
    made = benchmark.features(s1, others, B.cool(B.bench_keys(others, vocabulary=words), ["key_type", "key"], 12))
    assert [c for c in made.columns if c in benchmark.NOT_FEATURES] == ["s1_id", "src", "id", "mask"]
    names = benchmark.feature_names(made)
    assert len(names) == 59
    found = stage(B.bench_pairs(s1, others, 12, vocabulary=words))
    named = s1.select("id", "name_norm").unionByName(others.select("id", "name_norm"))
    want = X.bench_features(found, s1, others)
    for name, (_, grams) in benchmark.WEIGHED.items():
        want = want.join(X.tfidf_cosine(found, named, grams).withColumnRenamed("cosine", name), ["s1_id", "id"])
    want = want.join(others.select("id", "src"), "id")
    both = [{(r.s1_id, r.id): r for r in x.select("s1_id", "src", "id", "mask", *(F.round(c, 9).alias(c) for c in names)).collect()} for x in (made, want)]
    assert made.count() == len(both[0]) > 500 and both[0] == both[1]
    assert any(r.mask.bit_count() > 1 for r in both[0].values())
