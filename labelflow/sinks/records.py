"""Labelled records as CSV or Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame

from labelflow.sources.records import canonical


def write_records(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet table, the format for further jobs."""
    df.write.mode(mode).parquet(path)


def write_records_csv(
    df: DataFrame, path: str, mode: str = "errorifexists", byte_order_mark: bool = False
) -> None:
    """CSV files with a header, UTF-8, doubled quotes; null and blank are both written empty.

    With `byte_order_mark`, each file begins with one, by which spreadsheets know the encoding: it
    is written as the first character of the header.
    """
    marked = {df.columns[0]: "\ufeff" + df.columns[0]} if byte_order_mark else {}
    df.withColumnsRenamed(marked).write.mode(mode).csv(
        path, header=True, escape='"', emptyValue="", nullValue="", encoding="UTF-8",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def write_collected_csv(
    df: DataFrame, path: str, mode: str = "errorifexists", byte_order_mark: bool = False
) -> None:
    """Collected records under the fixed 13-column header."""
    write_records_csv(canonical(df), path, mode, byte_order_mark)
