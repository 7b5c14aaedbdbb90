"""Ordered keyword lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelflow.functions.text import strip
from labelflow.schema import SEARCH_KEYWORDS


def read_keywords(spark: SparkSession, path: str) -> DataFrame:
    """Keyword files, one per line: `(pos, keyword)` with blanks dropped, in order of file name and line."""
    lines = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"),
        F.posexplode(F.split(F.regexp_replace("value", "^\\ufeff", ""), r"\r\n|\r|\n")).alias("line", "raw")
    )
    kept = lines.select("file", "line", strip(F.col("raw")).alias("keyword")).filter("keyword != ''")
    # Numbered per file, behind the lines of the files before it: one row a file meets in one task.
    in_file = kept.selectExpr("file", "row_number() OVER (PARTITION BY file ORDER BY line) - 1 AS place", "keyword")
    before = kept.groupBy("file").agg(F.count("*").alias("lines")).selectExpr(
        "file", "sum(lines) OVER (ORDER BY file) - lines AS before")
    return in_file.join(before, "file").selectExpr("CAST(before + place AS int) AS pos", "keyword")


def keyword_table(spark: SparkSession, keywords: Sequence[str] = SEARCH_KEYWORDS) -> DataFrame:
    """`(pos, keyword)` of a list given in code."""
    return spark.createDataFrame(list(enumerate(keywords)), "pos int, keyword string")


def keyword_list(table: DataFrame) -> list[str]:
    """Keywords of a short table in order, for use as literals of a search."""
    return [r.keyword for r in table.orderBy("pos").select("keyword").collect()]
