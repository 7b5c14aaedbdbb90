import math

import pytest
from pyspark.sql import functions as F

from labelflow.functions.codes import at_index, lookup, lookup_or_blank
from labelflow.functions.text import (
    combined_text,
    fixed,
    has_text,
    is_sentinel,
    keyword_groups,
    na_to_null,
    strip,
)
from labelflow.functions.tokens import attention_mask, lost_tokens, model_window, whitespace_tokens
from labelflow.functions.vectors import argmax, linear_logits, log_softmax_at, softmax
from labelflow.schema import NA_TOKENS, TEXT_SEPARATOR


def one(spark, column, **values):
    """Value of `column` over one row; values are given as (value, type)."""
    schema = ", ".join(f"{k} {t}" for k, (_, t) in values.items()) or "x int"
    data = [tuple(v for v, _ in values.values()) or (1,)]
    return spark.createDataFrame(data, schema).select(column.alias("out")).first().out


@pytest.mark.parametrize("raw", ["  a b ", "\ta　", "　a\x1f", "a", "", " \t\n　", None])
def test_strip_is_python_strip(spark, raw):
    got = one(spark, strip(F.col("s")), s=(raw, "string"))
    assert got == (None if raw is None else raw.strip())
    filled = one(spark, has_text(F.col("s")), s=(raw, "string"))
    assert filled is bool(raw and raw.strip())


def test_missing_value_tokens(spark):
    assert len(NA_TOKENS) == 19
    values = [*NA_TOKENS, "na", "none", " NA", "0", None]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    kept = [r.c for r in df.select(na_to_null(F.col("s")).alias("c")).collect()]
    assert kept == [None] * 19 + ["na", "none", " NA", "0", None]


def test_sentinel_is_never_null(spark):
    df = spark.createDataFrame([("EXC",), ("3",), (None,)], "c string")
    assert [r.b for r in df.select(is_sentinel(F.col("c")).alias("b")).collect()] == [True, False, False]


@pytest.mark.parametrize("d, c, expected", [
    ("a", "b", "a" + TEXT_SEPARATOR + "b"), (None, "b", TEXT_SEPARATOR + "b"),
    ("a", None, "a" + TEXT_SEPARATOR), (None, None, TEXT_SEPARATOR),
])
def test_combined_text(spark, d, c, expected):
    got = one(spark, combined_text(F.col("d"), F.col("c")), d=(d, "string"), c=(c, "string"))
    assert got == expected


@pytest.mark.parametrize("text, expected", [
    ("My DNA report", "유전자"), ("asking for help", "미용"), ("genetic SKIN test", "유전자,미용"),
    ("피부 유전자", "유전자,미용"), ("nothing", ""), ("", ""),
])
def test_keyword_groups(spark, text, expected):
    assert one(spark, keyword_groups(F.col("t")), t=(text, "string")) == expected


@pytest.mark.parametrize("value", [0.125, 0.165, 0.145, 0.5, 1.0, 2 / 3, 0.0, 1234.565])
def test_fixed_rounds_like_python(spark, value):
    assert one(spark, fixed(F.col("x"), 2), x=(value, "double")) == f"{value:.2f}"


def test_softmax_sums_to_one_and_survives_large_logits(spark):
    got = one(spark, softmax(F.col("l")), l=([1000.0, 1001.0, 999.0], "array<double>"))
    assert sum(got) == pytest.approx(1.0)
    powers = [math.exp(v) for v in (-1.0, 0.0, -2.0)]
    assert got == pytest.approx([p / sum(powers) for p in powers])
    assert one(spark, softmax(F.col("l")), l=(None, "array<double>")) is None


@pytest.mark.parametrize("values, index", [
    ([0.2, 0.4, 0.4], 1), ([1.0], 0), ([0.1, float("nan"), 0.9], 1), (None, None),
])
def test_argmax_takes_the_first_of_equals(spark, values, index):
    assert one(spark, argmax(F.col("p")), p=(values, "array<double>")) == index


def test_log_softmax_matches_its_definition(spark):
    logits = [0.3, -1.2, 2.0]
    total = math.log(sum(math.exp(v) for v in logits))
    for i, v in enumerate(logits):
        got = one(spark, log_softmax_at(F.col("l"), F.lit(i)), l=(logits, "array<double>"))
        assert got == pytest.approx(v - total)


def test_linear_logits(spark):
    got = one(
        spark, linear_logits(F.col("x"), [[1.0, 2.0], [0.5, -1.0]], [0.25, 0.0]),
        x=([2.0, 3.0], "array<float>"),
    )
    assert got == [8.25, -2.0]


def test_lookups(spark):
    table = {"A": "x", "B": "y"}
    assert one(spark, lookup(F.col("k"), table), k=("A", "string")) == "x"
    assert one(spark, lookup(F.col("k"), table), k=("Z", "string")) is None
    assert one(spark, lookup(F.col("k"), table), k=(None, "string")) is None
    assert one(spark, lookup_or_blank(F.col("k"), table), k=("Z", "string")) == ""
    assert one(spark, at_index([7, 9], F.col("i")), i=(1, "int")) == 9
    assert one(spark, at_index([7, 9], F.col("i")), i=(2, "int")) is None


@pytest.mark.parametrize("text, tokens", [
    ("a  b\nc", ["a", "b", "c"]), (" a ", ["a"]), ("", []), ("  ", []), (None, []),
])
def test_token_windows(spark, text, tokens):
    got = one(spark, whitespace_tokens(F.col("t")), t=(text, "string"))
    assert got == tokens
    window = one(spark, model_window(whitespace_tokens(F.col("t")), 4), t=(text, "string"))
    assert window == (["[CLS]", *tokens[:2], "[SEP]"] + ["[PAD]"] * 4)[:4]
    mask = one(spark, attention_mask(whitespace_tokens(F.col("t")), 4), t=(text, "string"))
    assert mask == [1] * min(4, len(tokens) + 2) + [0] * max(0, 2 - len(tokens))
    lost = one(spark, lost_tokens(F.size(whitespace_tokens(F.col("t"))), 4), t=(text, "string"))
    assert lost == max(0, len(tokens) - 2)
