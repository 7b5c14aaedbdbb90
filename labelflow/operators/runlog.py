"""Best checkpoint, early stopping and model selection over epoch metrics.

Input rows are `(run, epoch, ..., avg_f1)`, with `segment` where logs hold restarted runs: then each
segment is a run of its own. Copies of a logged epoch are dropped first, so a window holds the epochs
of one run, which its trainer bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelflow.schema import DEFAULT_PATIENCE


def _keys(epochs: DataFrame) -> list[str]:
    return ["run", *[c for c in ("segment", "axes") if c in epochs.columns]]


def mark_best(epochs: DataFrame, score: str = "avg_f1") -> DataFrame:
    """Add `is_best`: the score passes every earlier one of the run, starting from zero."""
    earlier = W.partitionBy(*_keys(epochs)).orderBy("epoch").rowsBetween(W.unboundedPreceding, -1)
    best = F.coalesce(F.max(score).over(earlier), F.lit(0.0))
    return epochs.distinct().withColumn("is_best", F.col(score) > F.greatest(best, F.lit(0.0)))


def early_stopping(
    epochs: DataFrame, patience: int = DEFAULT_PATIENCE, score: str = "avg_f1"
) -> DataFrame:
    """Epochs up to the stop, with `is_best`, `streak` without improvement and `stops`."""
    run = W.partitionBy(*_keys(epochs)).orderBy("epoch")
    so_far = run.rowsBetween(W.unboundedPreceding, 0)
    # Logged epochs are counted, not their numbers: a log may have gaps.
    marked = mark_best(epochs, score).withColumn("place", F.row_number().over(run))
    last_best = F.max(F.when(F.col("is_best"), F.col("place"))).over(so_far)
    marked = marked.withColumn("streak", F.col("place") - F.coalesce(last_best, F.lit(0))).drop("place")
    stop = F.min(F.when(F.col("streak") >= patience, F.col("epoch"))).over(so_far)
    return (
        marked.withColumn("stop_epoch", stop)
        .filter(F.col("stop_epoch").isNull() | (F.col("epoch") <= F.col("stop_epoch")))
        .withColumn("stops", F.col("stop_epoch").isNotNull())
        .drop("stop_epoch")
    )


def best_checkpoints(
    epochs: DataFrame, patience: int = DEFAULT_PATIENCE, score: str = "avg_f1"
) -> DataFrame:
    """One row per run: epochs run, best epoch and score, stop epoch (null when it ran out)."""
    trained = early_stopping(epochs, patience, score)
    return trained.groupBy(*_keys(epochs)).agg(
        F.max("epoch").alias("epochs"),
        F.max(F.when(F.col("is_best"), F.col("epoch"))).alias("best_epoch"),
        F.max(F.when(F.col("is_best"), F.col(score))).alias("best_score"),
        F.max(F.when(F.col("stops"), F.col("epoch"))).alias("stop_epoch"),
    )


def rank_runs(checkpoints: DataFrame) -> DataFrame:
    """Best run first, ties by name and segment."""
    return checkpoints.orderBy(F.desc_nulls_last("best_score"), *_keys(checkpoints))


def with_logged_best(checkpoints: DataFrame, events: DataFrame) -> DataFrame:
    """Add `logged_best`, the best score that the trainer itself wrote into the log of the run."""
    best = events.select("run", F.array_max("best_scores").alias("logged_best"))
    return checkpoints.join(best, "run", "left")


def select_run(checkpoints: DataFrame) -> DataFrame:
    """The run to keep: one row."""
    return rank_runs(checkpoints).limit(1)
