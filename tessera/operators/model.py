"""Gradient-boosted pair classifier. NULL features become -1, outside every feature's range."""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def encoded(rows: DataFrame, features: list[str]) -> DataFrame:
    return rows.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(-1.0)) for f in features})


def fit(rows: DataFrame, features: list[str], rounds: int = 20, seed: int = 42) -> PipelineModel:
    """Fit on rows with ``label``; rows with split 'val', if there are any, stop the boosting early."""
    labelled = encoded(rows.where("label IS NOT NULL"), features).withColumn("label", F.col("label").cast("double"))
    stop = {}
    if "split" in rows.columns:
        labelled = labelled.withColumn("held", F.col("split") == "val")
        stop = {"validationIndicatorCol": "held"}
    trees = GBTClassifier(featuresCol="vector", labelCol="label", maxDepth=5, stepSize=0.06, minInstancesPerNode=20, subsamplingRate=0.9, featureSubsetStrategy="0.9", maxIter=rounds, seed=seed, **stop)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="vector"), trees]).fit(labelled)


def score(model: PipelineModel, rows: DataFrame, features: list[str], *more: str) -> DataFrame:
    """(s1_id, src, id, probability) of all rows; ``more`` columns stay, a missing feature column is an error."""
    lacking = [f for f in features if f not in rows.columns]
    if lacking:
        raise ValueError(f"missing feature columns: {lacking}")
    out = model.transform(encoded(rows, features))
    return out.select("s1_id", "src", "id", vector_to_array("probability")[1].alias("probability"), *more)


def importances(model: PipelineModel, features: list[str]) -> list[tuple[str, float]]:
    return sorted(zip(features, model.stages[-1].featureImportances.toArray().tolist(), strict=True), key=lambda x: -x[1])


def save(model: PipelineModel, path: str, features: list[str]) -> None:
    """The model and the order of its features, through Spark's own writers."""
    spark = SparkSession.active()
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(json.dumps(features),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/features")


def load(spark, path: str) -> tuple[PipelineModel, list[str]]:
    features = json.loads(spark.read.text(f"{path}/features").head().value)
    return PipelineModel.load(f"{path}/model"), features
