"""Reports as tables and as text."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_report(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Report table: a few rows per class, so one file."""
    report.coalesce(1).write.mode(mode).parquet(path)


def write_report_text(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Lines `(axis, line_no, line)`, or without axes, as one text file, in order."""
    axis = ["axis"] if "axis" in lines.columns else []
    ordered = lines.orderBy(*axis, "line_no").select("line")
    ordered.coalesce(1).write.mode(mode).text(path)
