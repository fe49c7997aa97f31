"""The trained model: gradient-boosted trees on url features, labels from the rule model, isotonic calibration."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import MODEL_INPUTS, model_features
from ..sources.shared import release, shared_folder, workspace
from .scoring import clip

# fixed values: range of the targets, and the score of curated urls
LOW, HIGH, CURATED = -5.0, 2.0, 2.0
#: Hashes of urls that come several times which are sent to the tasks at most (8 bytes each).
MOST_SEVERAL = 1_000_000


def features(rows: DataFrame) -> DataFrame:
    """url and the 42 model inputs; a missing input column is an error."""
    inputs = model_features()
    return rows.select("url", *[inputs[name].alias(name) for name in MODEL_INPUTS])


def _label() -> Column:
    return F.when(F.col("data_source") == "good_data", CURATED).otherwise(clip(F.col("score"), LOW, HIGH))


def targets(scored: DataFrame) -> DataFrame:
    """(url, label) from rule scores: one a url, curated ones at CURATED, within the range."""
    return scored.withColumn("label", _label()).groupBy("url").agg(F.max("label").alias("label"))


def train(rows: DataFrame, labels: DataFrame, trees: int = 30, depth: int = 5, seed: int = 42) -> PipelineModel:
    """Fits trees with absolute loss and calibrates their predictions once; about a tenth of the urls, by hash, validates."""
    return train_features(features(rows), labels, trees, depth, seed)


def held_back() -> Column:
    """The tenth of the urls that trees are validated on, not fitted to."""
    return F.pmod(F.xxhash64("url"), F.lit(10)) == 0


def train_features(table: DataFrame, labels: DataFrame, trees: int = 30, depth: int = 5, seed: int = 42) -> PipelineModel:
    """train over url and model inputs that have been computed before."""
    return _fitted(table.dropDuplicates(["url"]).join(labels, "url"), trees, depth, seed)


def train_scored(rows: DataFrame, trees: int = 30, depth: int = 5, seed: int = 42) -> PipelineModel:
    """train_features over (url, score, data_source, model inputs) that have been written, with the targets of the same rows: only
    rows whose url comes several times are exchanged, which a hash of the url tells. Where these are more than can be sent to the tasks, all are."""
    rows = rows.filter("url is not null")
    with workspace(rows.sparkSession, shared_folder(rows.sparkSession, "training")) as put:
        hashed = rows.select(F.xxhash64("url").alias("_key")).groupBy("_key").agg(F.count("*").alias("_n"))
        several = put(hashed.filter("_n > 1").select("_key"))
        if several.count() > MOST_SEVERAL:
            return train_features(rows.drop("score", "data_source"), targets(rows), trees, depth, seed)
        release(rows.sparkSession)
        keyed = rows.withColumns({"_key": F.xxhash64("url"), "label": _label()}).drop("score", "data_source")
        again = keyed.join(F.broadcast(several), "_key", "left_semi")
        best = again.groupBy("url").agg(F.max("label").alias("label"))
        once = again.drop("label").dropDuplicates(["url"]).join(best, "url")
        return _fitted(keyed.join(F.broadcast(several), "_key", "left_anti").unionByName(once), trees, depth, seed)


def _fitted(table: DataFrame, trees: int, depth: int, seed: int) -> PipelineModel:
    """The model of (url, label, model inputs), one row a url. Urls that agree in inputs and label are one row of their number's weight,
    and predictions are calibrated by the mean label of each: both are written, so that what is above them runs once."""
    spark = table.sparkSession
    assemble = VectorAssembler(inputCols=MODEL_INPUTS, outputCol="features", handleInvalid="keep")
    boosted = GBTRegressor(lossType="absolute", stepSize=0.1, maxIter=trees, maxDepth=depth, subsamplingRate=0.7, featureSubsetStrategy="0.7", seed=seed, validationIndicatorCol="held_back", validationTol=1e-6, predictionCol="raw", weightCol="weight")
    calibrated = IsotonicRegression(featuresCol="raw", predictionCol="calibrated", weightCol="weight")
    with workspace(spark, shared_folder(spark, "training")) as put:
        alike = put(table.groupBy(*MODEL_INPUTS, "label", held_back().alias("held_back")).agg(F.count("*").cast("double").alias("weight")))
        release(spark)
        trees_model = boosted.fit(assemble.transform(alike))
        weight = F.sum("weight")
        raw = trees_model.transform(assemble.transform(alike)).groupBy("raw").agg((F.sum(F.col("label") * F.col("weight")) / weight).alias("label"), weight.alias("weight"))
        return PipelineModel([assemble, trees_model, calibrated.fit(put(raw))])


def predict(rows: DataFrame, model: PipelineModel) -> DataFrame:
    """(url, score, is_spam, risk_score, trust_score, composite_score, confidence)."""
    return predict_features(features(rows), model)


def predict_features(table: DataFrame, model: PipelineModel) -> DataFrame:
    return model.transform(table).select("url", *_judged())


def _judged() -> list[Column]:
    score = clip(F.col("calibrated"), LOW, HIGH)
    one = lambda c: clip(c, 0.0, 1.0)
    risk, trust = one(F.greatest(F.lit(0.0), -score) / 5), one(F.greatest(F.lit(0.0), score) / 2)
    return [score.alias("score"), (score < -1.5).alias("is_spam"), risk.alias("risk_score"), trust.alias("trust_score"), (trust - risk).alias("composite_score"), (1 / (1 + F.exp(-score))).alias("confidence")]


def judged(rows: DataFrame, model: PipelineModel) -> DataFrame:
    """rows with features, all their columns, and the model's score and its parts beside them."""
    inputs = model_features()
    wide = rows.select(F.struct(*rows.columns).alias("_row"), *[inputs[name].alias(name) for name in MODEL_INPUTS])
    return model.transform(wide).select("_row.*", *_judged())


def evaluate(predicted: DataFrame, labels: DataFrame) -> DataFrame:
    """One row over the held-back urls: their number, the correlation of predictions and labels, the mean absolute error."""
    both = predicted.filter(held_back()).join(labels, "url")
    return both.agg(F.count("*").alias("urls"), F.corr("score", "label").alias("correlation"), F.avg(F.abs(F.col("score") - F.col("label"))).alias("mean_error"))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
