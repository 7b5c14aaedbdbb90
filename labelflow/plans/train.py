"""Train two heads on labelled records and report on the held-out rows."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelflow.functions.vectors import argmax
from labelflow.operators.contract import assert_trainable
from labelflow.operators.encode import category_dictionary, encode_labels, encode_single_axis
from labelflow.operators.heads import (
    score_heads,
    train_two_heads,
    train_weighted_text_head,
)
from labelflow.operators.metrics import (
    category_slice,
    class_report,
    confusion,
    model_score,
    over_all_slices,
    report_summary,
    slice_macro_f1,
)
from labelflow.operators.scoring import with_predictions
from labelflow.operators.side import label_side
from labelflow.operators.split import stratified_split
from labelflow.plans.prelabel import with_combined_text
from labelflow.scale import dimension, materialize
from labelflow.schema import DEFAULT_SEED, DEFAULT_TEST_SIZE
from labelflow.sources.models import LabelConfig

AXES = [
    ("category", "category_label", "category_pred"),
    ("function", "function_label", "function_pred"),
]


class Evaluation(NamedTuple):
    report: DataFrame  # per axis and class
    summary: DataFrame  # per axis
    score: DataFrame  # one row
    slices: DataFrame  # axis 2: all rows, sentinel rows, real rows


def prepare(
    records: DataFrame, key: str = "app_id",
    test_size: float = DEFAULT_TEST_SIZE, seed: int = DEFAULT_SEED,
    dictionary: DataFrame | None = None, side: DataFrame | None = None,
) -> DataFrame:
    """Checked, encoded and split records, written once for training and evaluation.

    The records are read twice: for the side table (unless given) and to be written.
    """
    side = label_side(records, key) if side is None else side
    assert_trainable(side)
    dictionary = category_dictionary(side) if dictionary is None else dictionary
    encoded = encode_labels(with_combined_text(records), dictionary)
    return materialize(stratified_split(encoded, key, "category_id", test_size, seed, side), "prepared")


def prepare_single_axis(
    records: DataFrame, key: str = "app_id",
    test_size: float = DEFAULT_TEST_SIZE, seed: int = DEFAULT_SEED, side: DataFrame | None = None,
) -> DataFrame:
    """The same for axis 1 alone: sentinel rows are left out before the split."""
    side = label_side(records, key) if side is None else side
    assert_trainable(side)
    dictionary = dimension(category_dictionary(side))
    encoded = encode_single_axis(with_combined_text(records), dictionary)
    real = encode_single_axis(side, dictionary)
    return materialize(stratified_split(encoded, key, "category_id", test_size, seed, real), "prepared")


def fit(prepared: DataFrame, **options) -> PipelineModel:
    return train_two_heads(prepared.filter("is_train"), **options)


def fit_weighted(prepared: DataFrame, **options) -> PipelineModel:
    return train_weighted_text_head(prepared.filter("is_train"), **options)


def categories_of(records: DataFrame) -> list[int]:
    """Category ids in label order."""
    rows = dimension(category_dictionary(records)).orderBy("category_label").collect()
    return [r.category for r in rows]


def evaluate(predicted: DataFrame) -> Evaluation:
    """Diagnostics of rows with labels, predictions and `category_id`; one pass over the rows."""
    sliced = predicted.withColumn("slice", category_slice(F.col("category_id")))
    by_slice = materialize(confusion(sliced, AXES, ["slice"]), "confusion")
    counts = by_slice.groupBy("axis", "truth", "predicted").agg(F.sum("n").alias("n"))
    report = class_report(counts)
    summary = report_summary(report)
    function_counts = over_all_slices(by_slice.filter("axis = 'function'"), "slice")
    return Evaluation(
        report, summary, model_score(summary), slice_macro_f1(function_counts, "slice")
    )


def evaluate_heads(model: PipelineModel, prepared: DataFrame, config: LabelConfig) -> Evaluation:
    """Evaluation of fitted heads on the held-out rows; only those are scored."""
    held_out = prepared.filter("NOT is_train")
    scored = with_predictions(
        score_heads(model, held_out), config.categories, config.functions
    )
    return evaluate(scored)


def evaluate_weighted_head(model: PipelineModel, prepared: DataFrame) -> DataFrame:
    """Class report of a single-axis model on the held-out rows."""
    held_out = prepared.filter("NOT is_train")
    scored = score_heads(model, held_out, axes=["category"])
    predicted = scored.withColumn("category_pred", argmax(F.col("category_logits")))
    return class_report(confusion(predicted, AXES[:1]))
