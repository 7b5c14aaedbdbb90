"""Merge of reviewed records into the labelled table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelflow.functions.text import has_text, is_sentinel
from labelflow.sources.records import canonical


def excluded(strict: bool = False) -> Column:
    """New rows that a merge leaves out: sentinel without a function; strict: every sentinel.

    Never null, so a row without a category stays.
    """
    sentinel = is_sentinel(F.col("category_id"))
    return sentinel if strict else sentinel & ~has_text(F.col("function_type"))


def merge_labeled(existing: DataFrame, new: DataFrame, strict: bool = False) -> DataFrame:
    """Existing rows as they are plus the kept new rows; a bag union by column name.

    Extra columns of `existing` survive and are null on new rows. Nothing is deduplicated.
    """
    kept = canonical(new.filter(~excluded(strict)))
    return existing.unionByName(kept, allowMissingColumns=True)


def merge_counts(existing: DataFrame, new: DataFrame, strict: bool = False) -> DataFrame:
    """One row: existing, new, dropped and merged rows. Reads two columns of each side."""
    old = existing.select(F.lit(True).alias("old"), F.lit(False).alias("drop"))
    fresh = new.select(F.lit(False).alias("old"), excluded(strict).alias("drop"))
    return old.unionAll(fresh).agg(
        F.count_if("old").alias("existing_rows"),
        F.count_if(~F.col("old") & ~F.col("drop")).alias("new_rows"),
        F.count_if("drop").alias("dropped_rows"),
        F.count_if(~F.col("drop")).alias("merged_rows"),
    )


def class_distribution(df: DataFrame) -> DataFrame:
    """`(axis, value, n)` of both label columns, nulls excluded, largest first.

    One aggregation over the pairs; the axes are split on its small result.
    """
    pairs = df.groupBy("category_id", "function_type").agg(F.count("*").alias("n"))
    return _split_axes(pairs).orderBy("axis", F.desc("n"), "value")


def _split_axes(pairs: DataFrame) -> DataFrame:
    axes = F.inline(F.array(
        F.struct(F.lit("category_id").alias("axis"), F.col("category_id").alias("value"), "n"),
        F.struct(F.lit("function_type").alias("axis"), F.col("function_type").alias("value"), "n"),
    ))
    return (
        pairs.select(axes)
        .filter(F.col("value").isNotNull())
        .groupBy("axis", "value").agg(F.sum("n").alias("n"))
    )
