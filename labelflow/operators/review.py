"""Review queue over scored records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def queue_order(key: str = "app_id", minority_first: bool = False) -> list[Column]:
    """Least confident first, rows without confidence last, ties by key; flagged rows first if asked."""
    flagged = [F.desc(F.coalesce(F.col("minority_candidate"), F.lit("")) != "")] if minority_first else []
    return [*flagged, F.asc_nulls_last("min_confidence"), F.asc(key)]


def review_order(scored: DataFrame, key: str = "app_id") -> DataFrame:
    """Least confident first, rows without confidence last, ties by key.

    Sorting samples its input first, so pass a written table when scoring is costly. The task
    number as last sort key lets equal rows spread over several ranges.
    """
    return (
        scored.withColumn("_task", F.spark_partition_id())
        .orderBy(F.asc_nulls_last("min_confidence"), key, "_task")
        .drop("_task")
    )


def review_top(
    scored: DataFrame, k: int, key: str = "app_id", minority_first: bool = False
) -> DataFrame:
    """The first `k` rows to review; each task keeps only its own best `k`."""
    return scored.orderBy(*queue_order(key, minority_first)).limit(k)


def first_rows(df: DataFrame, n: int, key: str) -> DataFrame:
    """The first `n` rows in key order: tables have no file order."""
    return df.orderBy(key).limit(n)


def confidence_summary(scored: DataFrame) -> DataFrame:
    """One row: rows, mean confidence per axis, rows with a keyword flag."""
    return scored.agg(
        F.count("*").alias("n"),
        F.avg("category_confidence").alias("mean_category_confidence"),
        F.avg("function_confidence").alias("mean_function_confidence"),
        F.count_if(F.col("minority_candidate") != "").alias("minority_candidates"),
    )


def flag_counts(scored: DataFrame) -> DataFrame:
    """`(flag, n)` for every keyword group that occurs; pre-counted by flag list.

    Blank lists leave after the split: an earlier filter would be pushed down to the scan and
    search the texts a second time.
    """
    lists = scored.groupBy("minority_candidate").agg(F.count("*").alias("n"))
    flags = lists.select(F.explode(F.split("minority_candidate", ",")).alias("flag"), "n")
    return flags.filter("flag <> ''").groupBy("flag").agg(F.sum("n").alias("n"))
