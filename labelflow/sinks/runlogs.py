"""Training-log text from epoch metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelflow.functions.text import fixed
from labelflow.sources.runlogs import ONE_AXIS_METRICS, TWO_AXIS_METRICS

# Fixed formats of one logged epoch; its numbers have four decimals.
_RECORD = (
    "Epoch %d/%d | Loss: %s | [축1] Acc: %s F1: %s "
    "| [축2] Acc: %s F1: %s | Avg F1: %s"
)
_ONE_AXIS_RECORD = "Epoch %d/%d | Loss: %s | Val Acc: %s | Val Macro F1: %s"


def format_epochs(epochs: DataFrame) -> DataFrame:
    """`(run, text)` with one line per epoch; a run has at most `max_epochs` lines."""
    return _format(epochs, _RECORD, TWO_AXIS_METRICS)


def format_one_axis_epochs(epochs: DataFrame) -> DataFrame:
    """The same for single-axis runs."""
    return _format(epochs, _ONE_AXIS_RECORD, ONE_AXIS_METRICS)


def _format(epochs: DataFrame, record: str, metrics: list[str]) -> DataFrame:
    numbers = [fixed(F.col(c), 4) for c in metrics]
    line = F.format_string(record, "epoch", "max_epochs", *numbers)
    lines = F.array_sort(F.collect_set(F.struct("epoch", line.alias("line"))))
    return epochs.groupBy("run").agg(
        F.array_join(F.transform(lines, lambda r: r["line"]), "\n").alias("text")
    )
