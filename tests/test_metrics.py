import math
import random

import pytest
from conftest import rows

from labelflow.operators.encode import class_weights
from labelflow.operators.losses import two_axis_log_loss, weighted_log_loss
from labelflow.operators.metrics import (
    category_slice,
    class_report,
    confusion,
    model_score,
    over_all_slices,
    report_lines,
    report_summary,
    slice_macro_f1,
)
from pyspark.sql import functions as F

# truth, prediction: class 2 is predicted but never true, class 3 true but never predicted
PAIRS = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(1, 2)] + [(3, 0)] * 2
SCHEMA = "y int, p int, slice string"


def brute_f1(pairs, c):
    tp = sum(t == c == p for t, p in pairs)
    both = sum(t == c for t, _ in pairs) + sum(p == c for _, p in pairs)
    return 2 * tp / both if both else 0.0


def frame(spark, pairs, slices=None):
    data = [(t, p, (slices or ["s"])[i % len(slices or ["s"])]) for i, (t, p) in enumerate(pairs)]
    return spark.createDataFrame(data, SCHEMA)


def report_of(spark, pairs):
    return class_report(confusion(frame(spark, pairs), [("a", "y", "p")]))


def test_report_over_the_union_of_classes(spark):
    got = {r["class"]: r for r in report_of(spark, PAIRS).collect()}
    assert sorted(got) == [0, 1, 2, 3]
    assert (got[0].precision, got[0].recall, got[0].support) == (5 / 7, 5 / 7, 7)
    assert (got[2].precision, got[2].recall, got[2].f1, got[2].support) == (0.0, 0.0, 0.0, 0)
    assert (got[3].precision, got[3].recall, got[3].f1) == (0.0, 0.0, 0.0)
    for c in got:
        assert got[c].f1 == pytest.approx(brute_f1(PAIRS, c))


def test_summary(spark):
    report = report_of(spark, PAIRS)
    got = report_summary(report).first()
    assert got.accuracy == 8 / 13
    assert got.macro_f1 == pytest.approx(sum(brute_f1(PAIRS, c) for c in range(4)) / 4)
    weighted = (7 * brute_f1(PAIRS, 0) + 4 * brute_f1(PAIRS, 1)) / 13
    assert got.weighted_f1 == pytest.approx(weighted)
    assert got.support == 13


def test_axes_ignore_their_own_null_truth(spark):
    df = spark.createDataFrame([(0, 0, None, 1), (1, 0, 1, 1), (None, 1, 0, 0)], "y int, p int, z int, q int")
    got = rows(confusion(df, [("a", "y", "p"), ("b", "z", "q")]))
    assert got == [("a", 0, 0, 1), ("a", 1, 0, 1), ("b", 0, 0, 1), ("b", 1, 1, 1)]
    summary = report_summary(class_report(confusion(df, [("a", "y", "p"), ("b", "z", "q")])))
    assert model_score(summary).first()[0] == pytest.approx((1 / 3 + 1.0) / 2)


def test_a_missing_prediction_is_a_miss(spark):
    got = report_summary(report_of(spark, [(0, 0), (0, None), (1, 1)])).first()
    assert got.accuracy == 2 / 3 and got.support == 3


def test_slices_use_their_own_true_classes(spark):
    pairs = [(0, 0), (0, 1), (1, 1), (1, 1), (2, 0), (0, 0)]
    df = frame(spark, pairs, ["x", "y"])
    counts = over_all_slices(confusion(df, [("a", "y", "p")], ["slice"]), "slice")
    got = {r.slice: (r.n, r.macro_f1) for r in slice_macro_f1(counts, "slice").collect()}
    parts = {"x": pairs[0::2], "y": pairs[1::2], "all": pairs}
    assert set(got) == set(parts)
    for name, part in parts.items():
        classes = {t for t, _ in part}
        expected = sum(brute_f1(part, c) for c in classes) / len(classes)
        assert got[name] == (len(part), pytest.approx(expected))


def test_category_slice(spark):
    df = spark.createDataFrame([("EXC",), ("3",), (None,)], "c string")
    assert [r[0] for r in df.select(category_slice(F.col("c"))).collect()] == ["EXC", "real", "real"]


def test_metrics_do_not_depend_on_partitioning(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(5), rng.randrange(5)) for _ in range(2000)]
    one = rows(class_report(confusion(frame(spark, pairs).coalesce(1), [("a", "y", "p")])))
    many = rows(class_report(confusion(frame(spark, pairs).repartition(13), [("a", "y", "p")])))
    assert one == many


def test_text_lines(spark):
    lines = [r.line for r in report_lines(report_of(spark, PAIRS), {"a": {0: "zero"}}).orderBy("line_no").collect()]
    assert lines[0].split() == ["precision", "recall", "f1-score", "support"]
    assert lines[1] == "          zero      0.71      0.71      0.71         7"
    assert [line.split()[0] for line in lines[5:]] == ["accuracy", "macro", "weighted"]
    assert lines[5].split() == ["accuracy", "0.62", "13"]


def test_losses(spark):
    data = [([1.0, 0.0], [0.0, 2.0, 0.0], 0, 1), ([0.5, 0.5], [1.0, 0.0, 0.0], 1, 2), ([3.0, 1.0], [0.0, 0.0, 0.0], None, 0), ([0.0, 9.0], [0.0, 0.0, 1.0], 1, 2)]
    df = spark.createDataFrame(data, "c array<double>, f array<double>, category_label int, function_label int")

    def nll(logits, y):
        return math.log(sum(math.exp(v) for v in logits)) - logits[y]

    c = [nll(r[0], r[2]) for r in data if r[2] is not None]
    f = [nll(r[1], r[3]) for r in data]
    got = two_axis_log_loss(df, "c", "f").first()
    assert (got.category_rows, got.function_rows) == (3, 4)
    assert got.category_loss == pytest.approx(sum(c) / 3)
    assert got.loss == pytest.approx(sum(c) / 3 + sum(f) / 4)
    weights = {0: 3 / 2, 1: 3 / 4}
    expected = sum(weights[y] * v for y, v in zip([0, 1, 1], c)) / sum(weights[y] for y in [0, 1, 1])
    got = weighted_log_loss(df, "c", "category_label", class_weights(df, "category_label")).first()
    assert got.loss == pytest.approx(expected) and got.rows == 3
