"""Two classifiers on shared hashed-text features, fitted by Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelflow.operators.encode import class_weights, with_class_weight
from labelflow.scale import materialize

# Hash space of the text features; a gradient has this many entries per class.
FEATURES = 1 << 14
# A fit ends when the loss hardly changes, so its result does not depend on this many steps.
MAX_ITER, TOLERANCE = 500, 1e-8
# Each step of a fit is a job: its tasks get at least this many rows.
TASK_ROWS = 5_000

REGULARIZATION = 1e-2
# What a model of this module is fitted with unless a caller says otherwise.
FIT_DEFAULTS = {"num_features": FEATURES, "max_iter": MAX_ITER, "tolerance": TOLERANCE, "reg": REGULARIZATION}


def _text_features(text: str, num_features: int) -> Pipeline:
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="tokens", pattern=r"\s+"),
        HashingTF(inputCol="tokens", outputCol="counts", numFeatures=num_features),
        IDF(inputCol="counts", outputCol="features"),
    ])


def _head(axis: str, label: str, max_iter: int, reg: float, weight: str | None = None):
    head = LogisticRegression(
        family="multinomial", featuresCol="features", labelCol=label,
        predictionCol=f"{axis}_pred", probabilityCol=f"{axis}_probability",
        rawPredictionCol=f"{axis}_raw", maxIter=max_iter, regParam=reg, tol=TOLERANCE,
    )
    return head.setWeightCol(weight) if weight else head


def _for_fits(features: DataFrame) -> DataFrame:
    """Features written once, in no more partitions than their rows are worth, as every step reads them."""
    ready = materialize(features, "features")
    wanted = max(1, ready.count() // TASK_ROWS)
    return ready.coalesce(wanted)  # never more partitions than there are


def train_two_heads(
    train: DataFrame, text: str = "combined_text",
    category_label: str = "category_label", function_label: str = "function_label",
    num_features: int = FEATURES, max_iter: int = MAX_ITER, reg: float = REGULARIZATION,
) -> PipelineModel:
    """Features fitted once on `train`, then one multinomial head per axis.

    Rows without a label on an axis are ignored by that head only. With fixed features the sum of
    the two losses separates, so two fits minimize it.
    """
    rows = train.select(F.coalesce(F.col(text), F.lit("")).alias(text), category_label, function_label)
    features = _text_features(text, num_features).fit(rows)
    # Written once for both heads; each fit keeps blocks of its own.
    ready = _for_fits(features.transform(rows).select("features", category_label, function_label))
    heads = [
        _head(axis, label, max_iter, reg).fit(ready.filter(F.col(label).isNotNull()))
        for axis, label in (("category", category_label), ("function", function_label))
    ]
    return PipelineModel(stages=[*features.stages, *heads])


def score_heads(
    model: PipelineModel, df: DataFrame, text: str = "combined_text",
    axes: Sequence[str] = ("category", "function"),
) -> DataFrame:
    """Add `<axis>_logits` of fitted text heads; the features stay inside the JVM."""
    ready = df.withColumn(text, F.coalesce(F.col(text), F.lit("")))
    return model.transform(ready).select(
        *df.columns, *[vector_to_array(f"{axis}_raw").alias(f"{axis}_logits") for axis in axes]
    )


def _fit_weighted(ready: DataFrame, label: str, max_iter: int, reg: float) -> LogisticRegressionModel:
    """One head on `features`, rows weighted by the balanced class weights of these rows."""
    weighted = with_class_weight(ready, class_weights(ready, label), label)
    return _head("category", label, max_iter, reg, "weight").fit(weighted)  # keeps its own blocks


def train_weighted_text_head(
    train: DataFrame, text: str = "combined_text", label: str = "category_label",
    num_features: int = FEATURES, max_iter: int = MAX_ITER, reg: float = REGULARIZATION,
) -> PipelineModel:
    """Single-axis variant: text features and one class-weighted head."""
    rows = train.filter(F.col(label).isNotNull()).select(
        F.coalesce(F.col(text), F.lit("")).alias(text), label
    )
    features = _text_features(text, num_features).fit(rows)
    ready = _for_fits(features.transform(rows).select("features", label))
    return PipelineModel(stages=[*features.stages, _fit_weighted(ready, label, max_iter, reg)])


def train_weighted_head(
    train: DataFrame, vector: str, label: str, max_iter: int = MAX_ITER, reg: float = REGULARIZATION
) -> LogisticRegressionModel:
    """Class-weighted head on an array column, such as the output of an encoder."""
    rows = train.filter(F.col(label).isNotNull()).select(
        array_to_vector(F.col(vector).cast("array<double>")).alias("features"), label
    )
    return _fit_weighted(_for_fits(rows), label, max_iter, reg)


def predict_weighted_head(model: LogisticRegressionModel, df: DataFrame, vector: str) -> DataFrame:
    """Add `category_pred` as an integer label."""
    ready = df.withColumn("features", array_to_vector(F.col(vector).cast("array<double>")))
    return model.transform(ready).select(
        *df.columns, F.col("category_pred").cast("int").alias("category_pred")
    )


def score_weighted_head(model: LogisticRegressionModel, df: DataFrame, vector: str) -> DataFrame:
    """Add `category_logits`."""
    ready = df.withColumn("features", array_to_vector(F.col(vector).cast("array<double>")))
    return model.transform(ready).select(*df.columns, vector_to_array("category_raw").alias("category_logits"))
