import pytest
from conftest import rows
from test_merge import records

from labelflow.operators.encode import (
    category_dictionary,
    class_weights,
    encode_labels,
    encode_single_axis,
    with_class_weight,
)

LABELS = [("a", "10", "A"), ("b", "2", "D"), ("c", "EXC", "B"), ("d", "2", " "), ("e", None, "Z"), ("f", "02", None)]


def test_ids_are_ordered_as_numbers(spark):
    assert rows(category_dictionary(records(spark, LABELS))) == [(10, 1), (2, 0)]


def test_both_axes(spark):
    got = rows(encode_labels(records(spark, LABELS)), "app_id", "category_label", "function_label")
    assert got == [
        ("a", 1, 0), ("b", 0, 3), ("c", None, 1), ("d", 0, None), ("e", None, None), ("f", 0, None)
    ]


def test_stored_dictionary_wins(spark):
    stored = spark.createDataFrame([(2, 5)], "category int, category_label int")
    got = rows(encode_labels(records(spark, LABELS[:2]), stored), "app_id", "category_label")
    assert got == [("a", None), ("b", 5)]


def test_bad_category_is_an_error(spark):
    with pytest.raises(Exception, match="(?i)cast"):
        encode_labels(records(spark, [("a", "x", "A")])).collect()


def test_single_axis_leaves_out_the_sentinel_only(spark):
    got = rows(encode_single_axis(records(spark, LABELS)), "app_id", "category_id", "category_label")
    assert got == [("a", 10, 1), ("b", 2, 0), ("d", 2, 0), ("e", None, None), ("f", 2, 0)]


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 3 + [(2,)] + [(None,)] * 5, "y int")
    weights = class_weights(df, "y")
    got = {r.y: (r.n, r.weight) for r in weights.collect()}
    assert got == {0: (6, 10 / 18), 1: (3, 10 / 9), 2: (1, 10 / 3)}
    total = with_class_weight(df.filter("y IS NOT NULL"), weights, "y").groupBy().sum("weight").first()[0]
    assert total == pytest.approx(10)


def test_many_classes_go_without_broadcast(spark, monkeypatch):
    from functools import partial

    from labelflow import scale
    from labelflow.operators import encode

    df = records(spark, LABELS)
    few = rows(encode_labels(df))
    monkeypatch.setattr(encode, "dimension", partial(scale.dimension, max_rows=1))
    assert rows(encode_labels(df)) == few
    assert rows(with_class_weight(*many(spark)), "y", "weight") == [(i % 5, 1.0) for i in sorted(range(50), key=lambda i: i % 5)]


def many(spark):
    df = spark.range(50).selectExpr("id % 5 AS y")
    return df, class_weights(df, "y"), "y"
