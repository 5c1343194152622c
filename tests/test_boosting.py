"""Boosting on distinct rows: the features and trees of a row for each pair."""

from collections import Counter

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tessera import catalog
from tessera.operators import boosting as G
from tessera.operators import distinct
from tessera.operators import features as X

SF = "/root/testdata/sf0.001"


def test_groups_are_all_pairs_by_bins(spark):
    rows, codes = distinct.groups(*catalog.sides(spark, SF), catalog.CFG, catalog.cut(spark, SF), catalog.TRUE, catalog.same_truth())
    assert sorted(f for some in codes.values() for f in some) == sorted(X.ENTITY_FEATURES)
    every = catalog.stage(catalog.entity_labelled(spark, SF).withColumn("n", F.lit(1)))
    limits = G.splits(every, X.ENTITY_FEATURES)
    want = every.select("label", *(G.packed(some, limits)[0].alias(c) for c, some in codes.items()))
    got = {tuple(r[:-1]): r.n for r in rows.select("label", *codes, "n").collect()}
    assert got == Counter(map(tuple, want.collect()))
    assert sum(got.values()) == every.count()


def test_splits_are_equal_shares(spark):
    rows = spark.range(1000).select((F.col("id") * 0.5).alias("many"), F.when(F.col("id") < 990, 1).alias("few"), F.lit(2).cast("long").alias("n"))
    limits = G.splits(rows, ["many", "few"])
    assert limits["few"] == [0.0]  # NULL is -1
    assert len(limits["many"]) == 31
    assert np.abs(np.diff([0, *limits["many"], 500]) - 500 / 32).max() <= 0.5


def test_trees_are_the_librarys(spark):
    draw = np.random.default_rng(1)
    x = draw.integers(0, 9, (400, 3))
    n = draw.integers(1, 6, 400)
    label = (x[:, 0] * 2 + x[:, 1] + draw.normal(0, 3, 400) > 12).astype(int)
    data = [(*map(int, r), int(y), int(k)) for r, y, k in zip(x, label, n, strict=True)]
    rows = spark.createDataFrame(data, "a int, b int, c int, label int, n long")
    names = ["a", "b", "c"]
    coded = rows.select("label", "n", G.packed(names, G.splits(rows, names))[0].alias("x")).groupBy("label", "x").agg(F.sum("n").alias("n"))
    got = dict(G.importances(coded, {"x": names}, G.Boosting(rounds=3, rows=1.0, features=1.0)))
    each = VectorAssembler(inputCols=names, outputCol="vector").transform(rows.select("*", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("k")))
    trees = GBTClassifier(featuresCol="vector", labelCol="label", maxDepth=5, stepSize=0.06, minInstancesPerNode=20, subsamplingRate=1.0, featureSubsetStrategy="all", maxIter=3).fit(each)
    assert np.allclose([got[f] for f in names], trees.featureImportances.toArray(), atol=1e-6)


def test_rows_are_drawn_one_by_one(monkeypatch):
    key, n = np.arange(2000, dtype=np.uint64) * np.uint64(7919), np.tile([1, 5, 40, 900], 500)
    got = G.drawn(key, n, 0.9)
    assert abs(got.sum() / n.sum() - 0.9) < 0.005 and (got <= n).all()
    assert set(got[n == 1]) == {0, 1}
    assert 2 < got[n == 900].std() < 15  # 9 where rows are drawn on their own, 270 where a key's rows go together
    monkeypatch.setattr(G, "DRAWS", 64)
    assert (G.drawn(key, n, 0.9) == got).all()
