"""What a fixed model length keeps of each text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelflow.functions.tokens import (
    attention_mask,
    lost_tokens,
    model_window,
    token_count,
    whitespace_tokens,
)


def token_windows(df: DataFrame, text: str, max_len: int) -> DataFrame:
    """Add `input_tokens` (exactly `max_len`) and `attention_mask`."""
    return df.withColumn("_tokens", whitespace_tokens(F.col(text))).withColumns({
        "input_tokens": model_window(F.col("_tokens"), max_len),
        "attention_mask": attention_mask(F.col("_tokens"), max_len),
    }).drop("_tokens")


def with_token_count(df: DataFrame, text: str) -> DataFrame:
    """Replace the text by the number of its `tokens`; do so before any join or shuffle."""
    return df.withColumn("tokens", token_count(F.col(text)).cast("bigint")).drop(text)


def truncation_audit(counted: DataFrame, group: str, lengths: Sequence[int]) -> DataFrame:
    """Per group and model length: rows, share of texts cut, tokens in all, tokens lost."""
    per_length = counted.select(group, "tokens", F.inline(F.array(*[
        F.struct(F.lit(n).alias("max_len"), lost_tokens(F.col("tokens"), n).alias("lost"))
        for n in lengths
    ])))
    return per_length.groupBy(group, "max_len").agg(
        F.count("*").alias("n"),
        F.avg((F.col("lost") > 0).cast("double")).alias("share_cut"),
        F.sum("tokens").alias("tokens"),
        F.sum("lost").alias("tokens_lost"),
    )
