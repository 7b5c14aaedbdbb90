"""Cross-entropy of scored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelflow.functions.vectors import log_softmax_at
from labelflow.operators.encode import with_class_weight


def negative_log_likelihood(logits: Column, label: Column) -> Column:
    """`-log p(label)`; null where the label is null, so such rows are ignored."""
    return F.when(label.isNotNull(), -log_softmax_at(logits, F.coalesce(label, F.lit(0))))


def two_axis_log_loss(
    df: DataFrame, category_logits: str, function_logits: str,
    category_label: str = "category_label", function_label: str = "function_label",
) -> DataFrame:
    """One row: mean loss per axis over the rows labelled on it, and their sum."""
    losses = df.select(
        negative_log_likelihood(F.col(category_logits), F.col(category_label)).alias("c"),
        negative_log_likelihood(F.col(function_logits), F.col(function_label)).alias("f"),
    ).agg(
        F.avg("c").alias("category_loss"), F.count("c").alias("category_rows"),
        F.avg("f").alias("function_loss"), F.count("f").alias("function_rows"),
    )
    return losses.withColumn("loss", F.col("category_loss") + F.col("function_loss"))


def weighted_log_loss(df: DataFrame, logits: str, label: str, weights: DataFrame) -> DataFrame:
    """One row: class-weighted mean loss, `sum(w * loss) / sum(w)`."""
    rows = with_class_weight(df.filter(F.col(label).isNotNull()), weights, label).select(
        "weight", negative_log_likelihood(F.col(logits), F.col(label)).alias("nll")
    )
    return rows.agg(
        (F.sum(F.col("weight") * F.col("nll")) / F.sum("weight")).alias("loss"),
        F.count("nll").alias("rows"),
    )
