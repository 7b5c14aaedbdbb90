"""Checks of labelled records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelflow.functions.codes import lookup
from labelflow.functions.text import has_text, is_sentinel
from labelflow.schema import CATEGORY_NAMES, FUNCTION_INDEX


def label_contract(df: DataFrame) -> DataFrame:
    """`(rule, violations)` in one pass over the label columns."""
    category, function = F.col("category_id"), F.col("function_type")
    number = F.expr("try_cast(category_id AS INT)")
    real = category.isNotNull() & ~is_sentinel(category)
    rules = {
        "category_missing": category.isNull(),
        "category_not_integer": real & number.isNull(),
        "category_outside_guide": real & number.isNotNull() & ~number.isin(list(CATEGORY_NAMES)),
        "function_missing": ~has_text(function),
        "function_unknown": has_text(function) & lookup(function, FUNCTION_INDEX).isNull(),
        "boundary_without_note": (
            F.coalesce(F.col("is_boundary_case"), F.lit(False)) & ~has_text(F.col("note"))
        ),
    }
    counted = df.agg(*[F.count_if(bad).alias(name) for name, bad in rules.items()])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations")) for name in rules
    ])))


# Violations that stop a training run; the others are reported only.
TRAINING_RULES = ["category_missing", "category_not_integer"]


def assert_trainable(df: DataFrame, rules: list[str] = TRAINING_RULES) -> None:
    broken = label_contract(df).filter(F.col("rule").isin(rules) & (F.col("violations") > 0)).collect()
    if broken:
        raise ValueError("; ".join(f"{r.rule}: {r.violations} rows" for r in broken))


def function_violations(df: DataFrame) -> DataFrame:
    """`(function_type, n)` of the values outside the four codes, null included."""
    known = lookup(F.col("function_type"), FUNCTION_INDEX)
    return df.filter(known.isNull()).groupBy("function_type").agg(F.count("*").alias("n"))


def boundary_report(df: DataFrame) -> DataFrame:
    """Per category: rows marked as boundary cases, and those without a note."""
    marked = df.filter(F.col("is_boundary_case"))
    return marked.groupBy("category_id").agg(
        F.count("*").alias("boundary_rows"),
        F.count_if(~has_text(F.col("note"))).alias("without_note"),
    )
