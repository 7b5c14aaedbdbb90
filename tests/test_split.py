import hashlib
import math
from collections import Counter
from fractions import Fraction

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from labelflow.operators import split
from labelflow.operators.split import allocate, stratified_split

CLASSES = {"0": 400, "1": 61, "2": 7, "EXC": 212, "6": 2}


def brute_allocation(counts, test_size=0.2):
    total = sum(counts.values())
    train = total - math.ceil(total * test_size)
    quota = {c: Fraction(n * train, total) for c, n in counts.items()}
    base = {c: math.floor(q) for c, q in quota.items()}
    order = sorted(counts, key=lambda c: (-(quota[c] - base[c]), c))
    for c in order[: train - sum(base.values())]:
        base[c] += 1
    return base


def brute_split(data, seed=42):
    sizes = brute_allocation(Counter(c for _, c in data))
    train = set()
    for label, size in sizes.items():
        keys = [k for k, c in data if c == label]
        keys.sort(key=lambda k: (hashlib.md5(f"{k}|{seed}".encode()).hexdigest(), k))
        train |= set(keys[:size])
    return sorted((k, c, k in train) for k, c in data)


def labelled():
    return [(f"{c}-{i}", c) for c, n in CLASSES.items() for i in range(n)]


@settings(max_examples=15, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdefghij"), st.integers(1, 10**12), min_size=1))
def test_allocation_is_largest_remainder(spark, counts):
    df = spark.createDataFrame(list(counts.items()), "label string, n long")
    got = {r.label: r.n_train for r in allocate(df, "label").collect()}
    assert got == brute_allocation(counts)


@pytest.mark.parametrize("parts", [1, 6])
def test_same_rows_as_ranking_whole_classes(spark, parts):
    df = spark.createDataFrame(labelled(), "id string, label string").repartition(parts)
    assert rows(stratified_split(df, "id", "label")) == brute_split(labelled())


def test_seed_and_share(spark):
    df = spark.createDataFrame(labelled(), "id string, label string")
    one = stratified_split(df, "id", "label", test_size=0.5, seed=1)
    assert one.filter("is_train").count() == len(labelled()) // 2
    other = stratified_split(df, "id", "label", test_size=0.5, seed=2)
    assert rows(one) != rows(other)


def test_numeric_keys_and_other_columns_stay(spark):
    df = spark.range(100).selectExpr("id", "id % 3 AS label", "concat('t', id) AS text")
    got = stratified_split(df, "id", "label")
    assert got.columns == ["id", "label", "text", "is_train"]
    assert got.filter("is_train").count() == 80
    assert got.filter("text = concat('t', id)").count() == 100


@pytest.mark.parametrize("copies, contents", [(700, 700), (700, 1), (700, 3)])
def test_rows_that_share_one_key_are_divided_exactly(spark, monkeypatch, copies, contents):
    """A third of the table carries one key: as distinct rows, as copies of one, as copies of few."""
    monkeypatch.setattr(split, "_COPY_BLOCK", 64)
    data = [("same", "a", f"text {i % contents}") for i in range(copies)]
    data += [(f"k{i}", "a", "x") for i in range(1000)] + [(f"m{i}", "b", None) for i in range(400)]
    df = spark.createDataFrame(data, "id string, label string, text string").repartition(5)
    # The seed is one whose cut falls inside the shared key.
    for seed in range(60):
        h = lambda k: hashlib.md5(f"{k}|{seed}".encode()).hexdigest()
        below = sum(h(f"k{i}") < h("same") for i in range(1000))
        if below < 1360 < below + copies:
            break
    got = stratified_split(df, "id", "label", seed=seed)
    sizes = {r.label: r.n for r in got.filter("is_train").groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert sizes == {"a": 1360, "b": 320}
    assert rows(got.drop("is_train")) == sorted(data, key=repr)
    again = stratified_split(df.repartition(3), "id", "label", seed=seed)
    assert rows(got) == rows(again)
    assert got.filter("id = 'same'").select("is_train").distinct().count() == 2


def test_blank_keys_are_rows_like_others(spark):
    data = [(None if i % 3 == 0 else f"k{i}", "ab"[i % 2], i) for i in range(900)]
    df = spark.createDataFrame(data, "id string, label string, n long")
    got = stratified_split(df, "id", "label")
    assert got.filter("is_train").count() == 720
    assert rows(got.drop("is_train")) == sorted(data, key=repr)


@pytest.mark.parametrize("data", [
    [("a", "x"), ("b", "x"), ("c", None)],
    [(str(i), "x") for i in range(20)] + [("z", "rare")],
    [(str(i), f"c{i % 4}") for i in range(12)],
])
def test_impossible_splits_are_rejected(spark, data):
    df = spark.createDataFrame(data, "id string, label string")
    with pytest.raises(ValueError, match="stratified split"):
        stratified_split(df, "id", "label")


def test_no_window_over_rows_of_a_class(spark):
    df = spark.range(10_000).selectExpr("id", "id % 3 AS label")
    plan = stratified_split(df, "id", "label")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan


def test_many_classes_go_without_broadcast(spark, monkeypatch):
    """Above the size check the class tables are joined by shuffle; the rows stay the same."""
    from functools import partial

    from labelflow import scale

    monkeypatch.setattr(split, "table_and_rows", partial(scale.table_and_rows, max_rows=3))
    df = spark.createDataFrame(labelled(), "id string, label string").repartition(4)
    assert rows(stratified_split(df, "id", "label")) == brute_split(labelled())
    with pytest.raises(ValueError, match=r"EXC \(1 rows\)"):
        bad = labelled()[:468] + [("z", "EXC")]
        stratified_split(spark.createDataFrame(bad, "id string, label string"), "id", "label")
