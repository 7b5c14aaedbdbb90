"""The corpus pipeline: language ID, near-duplicate removal, decontamination, masking, packing.

Each stage takes all that the one before kept, and is written as Parquet before the next one reads
it. All but the last return the columns of `documents`; a table without rows passes as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelflow.llm import decontaminate, jaccard, language, packing, pii
from labelflow.scale import materialize


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labels tell; null, empty, letterless and far-off texts go."""
    return language.with_known_language(docs)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of near duplicates."""
    return jaccard.one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark, or one with other numbers and names."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; `n_chars` follows the text."""
    masked = pii.mask(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long"))


def pack_lengths(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each document in the batches of its length bucket."""
    return packing.pack(docs)


STAGES = [
    ("language_id", keep_known_languages),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("personal_data", mask_personal_data),
    ("packing", pack_lengths),
]

# No stage can be told in SQL; the tests hold run() against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
