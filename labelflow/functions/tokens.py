"""Whitespace tokens cut or padded to a fixed length."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Special tokens of the model input.
START, END, PAD = "[CLS]", "[SEP]", "[PAD]"
SPECIAL_TOKENS = 2


def whitespace_tokens(text: Column) -> Column:
    """Tokens of the whole text; an empty array for null or blank text."""
    parts = F.split(F.coalesce(text, F.lit("")), r"\s+")
    return F.filter(parts, lambda t: t != "")


def token_count(text: Column) -> Column:
    return F.size(whitespace_tokens(text))


def lost_tokens(n_tokens: Column, max_len: int) -> Column:
    """Tokens that do not fit beside the two special tokens."""
    return F.greatest(n_tokens - (max_len - SPECIAL_TOKENS), F.lit(0))


def model_window(tokens: Column, max_len: int) -> Column:
    """`max_len` tokens: start, as many tokens as fit, end, padding."""
    kept = F.slice(tokens, 1, max_len - SPECIAL_TOKENS)
    padding = F.array_repeat(F.lit(PAD), F.lit(max_len - SPECIAL_TOKENS) - F.size(kept))
    return F.concat(F.array(F.lit(START)), kept, F.array(F.lit(END)), padding)


def attention_mask(tokens: Column, max_len: int) -> Column:
    """1 for real and special tokens, 0 for padding."""
    real = F.least(F.size(tokens) + SPECIAL_TOKENS, F.lit(max_len))
    return F.concat(F.array_repeat(F.lit(1), real), F.array_repeat(F.lit(0), F.lit(max_len) - real))
