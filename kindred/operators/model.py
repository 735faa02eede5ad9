"""Splits, classifiers and scores of pairs."""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from kindred.functions.features import FEATURES_16


def entity_split(entities: DataFrame, test_percent: int = 20, seed: int = 42) -> DataFrame:
    """``entity_id, country, split``: the ids of least hash in each country, rounded up, are validation.

    Depends on ids and seed alone, not on partitions. A country ranks in two levels: hash ranges first.
    """
    ids = entities.select("entity_id", "country").distinct().withColumn("h", _drawn(seed))
    ids = ids.withColumn("range", F.substring("h", 1, 3))
    per = ids.groupBy("country", "range").agg(F.count("*").alias("c"))
    upto = Window.partitionBy("country").orderBy("range")
    per = per.select(F.col("country").alias("co"), F.col("range").alias("ra"), (F.sum("c").over(upto) - F.col("c")).alias("base"), F.sum("c").over(Window.partitionBy("country")).alias("n"))
    here = Window.partitionBy("country", "range").orderBy("h", "entity_id")
    ranked = ids.withColumn("here", F.row_number().over(here)).join(per, F.col("country").eqNullSafe(F.col("co")) & (F.col("range") == F.col("ra")))
    test = F.col("here") + F.col("base") <= F.ceil(F.col("n") * test_percent / 100)
    return ranked.select("entity_id", "country", F.when(test, "validation").otherwise("train").alias("split"))


def _drawn(seed: int):
    """A digest that puts ids in a random order which any engine can repeat."""
    return F.md5(F.concat(F.lit(f"{seed}-"), F.col("entity_id").cast("string")))


def entity_sample(entities: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``n`` records of least hash; the same ones whatever the partitions."""
    return entities.orderBy(_drawn(seed), "entity_id").limit(n)


def overlap(train: DataFrame, validation: DataFrame) -> DataFrame:
    """Entities on both sides; must be empty."""
    return train.select("s1_id").intersect(validation.select("s1_id"))


def numeric_features(pairs: DataFrame, out: tuple = ("label", "s1_id", "candidate_id")) -> list[str]:
    names = [f.name for f in pairs.schema if isinstance(f.dataType, NumericType) and f.name not in out]
    if not names:
        raise ValueError("no numeric feature column")
    return names


def check_training(pairs: DataFrame) -> None:
    """Raise unless there are rows and every label is 0 or 1."""
    row = pairs.agg(F.count("*").alias("n"), F.count_if(F.col("label").isNull() | ~F.col("label").isin(0, 1)).alias("bad")).first()
    if not row["n"]:
        raise ValueError("training pairs are empty")
    if row["bad"]:
        raise ValueError(f"{row['bad']} labels are not 0 or 1")


def build_classifier(iterations: int = 500, depth: int = 7, rate: float = 0.05, seed: int = 42, **options) -> GBTClassifier:
    return GBTClassifier(featuresCol="features", labelCol="label", maxIter=iterations, maxDepth=depth, stepSize=rate, seed=seed, **options)


def train(pairs: DataFrame, features: list[str] | None = None, classifier=None, validation: DataFrame | None = None) -> PipelineModel:
    """Fit any estimator; with ``validation`` rows boosting stops when they no longer gain. Entities must not be on both sides."""
    check_training(pairs)
    features = features or numeric_features(pairs)
    classifier = classifier or build_classifier()
    if validation is not None:
        if overlap(pairs, validation).limit(1).count():
            raise ValueError("entities are in training and validation")
        pairs = pairs.withColumn("is_validation", F.lit(False)).unionByName(validation.withColumn("is_validation", F.lit(True)), allowMissingColumns=True)
        if classifier.hasParam("validationIndicatorCol"):
            classifier = classifier.copy().setValidationIndicatorCol("is_validation")
    keep = ["label", *features] + (["is_validation"] if validation is not None else [])
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"), classifier]).fit(pairs.select(*keep))


def score(model: PipelineModel, pairs: DataFrame) -> DataFrame:
    """``pairs`` with ``match_probability`` of class 1; no rows give no rows."""
    have = {f.lower() for f in pairs.columns}
    missing = [f for f in model.stages[0].getInputCols() if f.lower() not in have]
    if missing:
        raise ValueError(f"feature columns are missing: {missing}")
    out = model.transform(pairs).withColumn("match_probability", vector_to_array("probability")[1])
    return out.select(*pairs.columns, "match_probability")


def importance(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """(feature, importance), most important first."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    rows = sorted(zip(model.stages[0].getInputCols(), values, strict=True), key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame(rows, "feature string, importance double")


def save(model: PipelineModel, path: str) -> None:
    """The model, and beside it the features it was trained on, in order."""
    model.write().overwrite().save(path)
    spark = SparkSession.active()
    meta = json.dumps({"features": model.stages[0].getInputCols(), "classes": [0, 1]})
    spark.createDataFrame([(meta,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}-schema")


def load(path: str, features: tuple[str, ...] = FEATURES_16) -> PipelineModel:
    """The saved model, if its features and their order are ``features`` and its classes are 0 and 1."""
    meta = json.loads(SparkSession.active().read.text(f"{path}-schema").first()["value"])
    if meta["features"] != list(features) or meta["classes"] != [0, 1]:
        raise ValueError(f"model schema differs: {meta}")
    return PipelineModel.load(path)


def search_threshold(scored: DataFrame, truth: DataFrame) -> tuple[int, float]:
    """Coarse grid 5..95 by 5, then by 1 within 5 of its best; (percent, macro F0.5), ties to the larger threshold."""
    from kindred.operators.evaluate import best_threshold, threshold_sweep

    coarse = best_threshold(threshold_sweep(scored, truth, list(range(5, 100, 5)))).first()
    near = [p for p in range(coarse["percent"] - 5, coarse["percent"] + 6) if 0 < p < 100]
    fine = best_threshold(threshold_sweep(scored, truth, near)).first()
    return fine["percent"], fine["macro_f0_5"]
