"""Labelled records from CSV or Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelflow.functions.text import has_text, is_sentinel, na_to_null
from labelflow.schema import AUDIT_COLUMNS, FUNCTION_INDEX, RECORD_SCHEMA

_AUDIT_TYPES = {
    "predicted_category_id": "int",
    "category_confidence": "double",
    "function_confidence": "double",
    "min_confidence": "double",
}
_TYPES = {"is_boundary_case": "boolean", **_AUDIT_TYPES}
_MARK = "\ufeff"  # byte-order mark of a file's first header


def normalize_missing(df: DataFrame) -> DataFrame:
    """Null for every missing-value token in every string column, in one projection."""
    return df.select([
        na_to_null(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType)
        else F.col(f.name)
        for f in df.schema.fields
    ])


def _cells(spark: SparkSession, path: str | list[str], multi_line: bool) -> DataFrame:
    """All cells as text, null for missing values; a byte-order mark is no part of the first name."""
    raw = spark.read.csv(
        path, header=True, multiLine=multi_line, escape='"', enforceSchema=False,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, encoding="UTF-8",
    )
    return normalize_missing(raw.withColumnsRenamed({c: c.removeprefix(_MARK) for c in raw.columns}))


def read_records_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Records of CSV files with a header; columns are matched by name, never by position.

    All values are read as text, so `category_id` keeps its sentinel; missing-value tokens become
    null, then the few typed columns are cast. A cell that is no value of its type is null;
    `rejected_cells` lists those. Files whose header differs from the first one are rejected. Quoted
    line breaks need `multi_line`, which makes one file one task: give large input as many files, or
    convert it once with `write_records`.
    """
    clean = _cells(spark, path, multi_line)
    return clean.select([
        F.col(c).try_cast(_TYPES[c]).alias(c) if c in _TYPES else F.col(c) for c in clean.columns
    ])


def rejected_cells(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """`(file, column, value, n)`: cells that their column cannot hold, and how often each occurs.

    In a typed column, that is what the cast turns into null; in the label columns, categories that
    are neither the sentinel nor an integer, and functions without a label. Missing values are no
    such cells. Only what is counted leaves the scan.
    """
    cells = _cells(spark, path, multi_line)
    value = {c: F.col(c) for c in cells.columns}
    bad = {c: value[c].try_cast(t).isNull() for c, t in _TYPES.items() if c in value}
    if "category_id" in value:
        bad["category_id"] = ~is_sentinel(value["category_id"]) & value["category_id"].try_cast("int").isNull()
    if "function_type" in value:
        bad["function_type"] = has_text(value["function_type"]) & ~value["function_type"].isin(list(FUNCTION_INDEX))
    found = F.array(*[
        F.when(value[c].isNotNull() & wrong, F.struct(F.lit(c).alias("column"), value[c].alias("value")))
        for c, wrong in bad.items()
    ])
    rows = cells.select(F.col("_metadata.file_path").alias("file"), F.explode(found).alias("cell"))
    return rows.filter("cell IS NOT NULL").groupBy("file", "cell.column", "cell.value").agg(F.count("*").alias("n"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of a Parquet table written by `write_records`."""
    return spark.read.parquet(path)


def canonical(df: DataFrame) -> DataFrame:
    """The 13 record columns in order, without audit columns; a missing column is an error."""
    return df.select(*RECORD_SCHEMA.fieldNames())


def without_audit(df: DataFrame) -> DataFrame:
    return df.drop(*AUDIT_COLUMNS)
