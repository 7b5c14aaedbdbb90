"""Epoch metrics and checkpoint events out of training-log text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Fixed formats of the log lines. Saved logs wrap a record over two lines, hence `\s+`.
TWO_AXIS_RECORD = (
    r"Epoch\s+(\d+)/(\d+)\s+\|\s+Loss:\s+(\S+)"
    r"\s+\|\s+\[축1\]\s+Acc:\s+(\S+)\s+F1:\s+(\S+)"
    r"\s+\|\s+\[축2\]\s+Acc:\s+(\S+)\s+F1:\s+(\S+)"
    r"\s+\|\s+Avg\s+F1:\s+(\S+)"
)
ONE_AXIS_RECORD = (
    r"Epoch\s+(\d+)/(\d+)\s+\|\s+Loss:\s+(\S+)"
    r"\s+\|\s+Val\s+Acc:\s+(\S+)\s+\|\s+Val\s+Macro\s+F1:\s+(\S+)"
)
BEST_EVENT = (
    r"Best\]?\s+(?:Large\s+)?[Mm]odel\s+saved\s+with\s+(?:Avg\s+)?Macro\s+F1:\s+(\d+\.\d+)"
)
STOP_EVENT = r"Early\s+stopping:\s+(\d+)\D+(\d+)"

TWO_AXIS_METRICS = ["loss", "acc1", "f1_1", "acc2", "f1_2", "avg_f1"]
ONE_AXIS_METRICS = ["loss", "acc", "macro_f1"]


def read_log_text(spark: SparkSession, path: str) -> DataFrame:
    """`(run, text)`, one row per log file."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_name").alias("run"), F.col("value").alias("text"))


def _parse(logs: DataFrame, pattern: str, metrics: list[str]) -> DataFrame:
    return _parse_lines(logs, pattern, metrics).drop("line")


def _parse_lines(logs: DataFrame, pattern: str, metrics: list[str]) -> DataFrame:
    """Logged epochs with `line`, their place among the records of their log."""
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    records = logs.select("run", F.posexplode(found).alias("line", "r"))
    part = lambda i: F.regexp_extract("r", pattern, i)
    return records.select(
        "run", "line",
        part(1).cast("int").alias("epoch"),
        part(2).cast("int").alias("max_epochs"),
        *[part(3 + i).cast("double").alias(name) for i, name in enumerate(metrics)],
    )


def parse_epochs(logs: DataFrame) -> DataFrame:
    """One row per logged epoch of two-axis runs, from `(run, text)`."""
    return _parse(logs, TWO_AXIS_RECORD, TWO_AXIS_METRICS)


def parse_one_axis_epochs(logs: DataFrame) -> DataFrame:
    """One row per logged epoch of single-axis runs."""
    return _parse(logs, ONE_AXIS_RECORD, ONE_AXIS_METRICS)


def _segments(lines: DataFrame, metrics: list[str]) -> DataFrame:
    """Replace `line` by `segment`, counted from 1: the part of a log that one start of a trainer wrote.

    A segment begins where the epoch falls, or stays with other numbers; a copy of the record before
    belongs to its segment. The window holds one log, whose trainer bounds its epochs.
    """
    log = W.partitionBy("run").orderBy("line")
    record = F.struct("epoch", "max_epochs", *metrics)
    before, epoch_before = F.lag(record).over(log), F.lag("epoch").over(log)
    begins = (F.col("epoch") < epoch_before) | ((F.col("epoch") == epoch_before) & (record != before))
    numbered = lines.withColumn("begins", F.coalesce(begins, F.lit(True)).cast("int"))
    return numbered.withColumn("segment", F.sum("begins").over(log).cast("int")).select(
        "run", "segment", "epoch", "max_epochs", *metrics)


def parse_segments(logs: DataFrame) -> DataFrame:
    """Logged epochs of two-axis runs with the `segment` of their log, so restarts are runs of their own."""
    return _segments(_parse_lines(logs, TWO_AXIS_RECORD, TWO_AXIS_METRICS), TWO_AXIS_METRICS)


def parse_one_axis_segments(logs: DataFrame) -> DataFrame:
    """The same of single-axis runs."""
    return _segments(_parse_lines(logs, ONE_AXIS_RECORD, ONE_AXIS_METRICS), ONE_AXIS_METRICS)


def parse_any(logs: DataFrame) -> DataFrame:
    """`(run, segment, axes, epoch, max_epochs, loss, score)` of all runs; the score compares checkpoints."""
    two = parse_segments(logs).withColumns({"axes": F.lit(2), "score": F.col("avg_f1")})
    one = parse_one_axis_segments(logs).withColumns({"axes": F.lit(1), "score": F.col("macro_f1")})
    columns = ["run", "segment", "axes", "epoch", "max_epochs", "loss", "score"]
    return two.select(*columns).unionByName(one.select(*columns))


def parse_events(logs: DataFrame) -> DataFrame:
    """What the trainer itself logged per run: best scores in order, and the stop epoch if any."""
    stop = F.regexp_extract("text", STOP_EVENT, 2)
    return logs.select(
        "run",
        F.transform(
            F.regexp_extract_all("text", F.lit(BEST_EVENT), 1), lambda s: s.cast("double")
        ).alias("best_scores"),
        F.when(stop != "", stop.cast("int")).alias("stop_epoch"),
    )
