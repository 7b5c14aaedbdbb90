from conftest import rows

from labelflow.operators.contract import (
    assert_trainable,
    boundary_report,
    function_violations,
    label_contract,
)
from labelflow.operators.merge import class_distribution, merge_counts, merge_labeled
from labelflow.schema import CANONICAL_COLUMNS

import pytest

TYPES = ", ".join(f"{c} {'boolean' if c == 'is_boundary_case' else 'string'}" for c in CANONICAL_COLUMNS)


def records(spark, labels):
    """Records with the given (app_id, category_id, function_type)."""
    data = [
        tuple({"app_id": a, "category_id": c, "function_type": f}.get(name) for name in CANONICAL_COLUMNS)
        for a, c, f in labels
    ]
    return spark.createDataFrame(data, TYPES)


NEW = [
    ("keep-real", "3", "A"), ("keep-real-blank", "3", " "), ("keep-null", None, None),
    ("keep-exc", "EXC", "B"), ("drop-null", "EXC", None), ("drop-blank", "EXC", " \t　"),
    ("drop-empty", "EXC", ""),
]
OLD = [("old-exc", "EXC", None), ("keep-real", "1", "D")]


def test_default_rule(spark):
    merged = merge_labeled(records(spark, OLD), records(spark, NEW))
    assert [r[0] for r in rows(merged, "app_id")] == [
        "keep-exc", "keep-null", "keep-real", "keep-real", "keep-real-blank", "old-exc"
    ]


def test_strict_rule_drops_every_new_sentinel(spark):
    merged = merge_labeled(records(spark, OLD), records(spark, NEW), strict=True)
    assert [r[0] for r in rows(merged, "app_id")] == [
        "keep-null", "keep-real", "keep-real", "keep-real-blank", "old-exc"
    ]


def test_extra_columns_of_the_existing_half_survive(spark):
    existing = records(spark, OLD).selectExpr("*", "'me' AS labeled_by")
    new = records(spark, NEW).selectExpr("*", "0.5D AS min_confidence")
    merged = merge_labeled(existing, new)
    assert merged.columns == [*CANONICAL_COLUMNS, "labeled_by"]
    assert set(rows(merged.filter("app_id LIKE 'old%'"), "labeled_by")) == {("me",)}
    assert set(rows(merged.filter("app_id LIKE 'keep-n%'"), "labeled_by")) == {(None,)}


@pytest.mark.parametrize("strict, new, dropped", [(False, 4, 3), (True, 3, 4)])
def test_counts_are_conserved(spark, strict, new, dropped):
    existing, fresh = records(spark, OLD), records(spark, NEW)
    got = merge_counts(existing, fresh, strict).first()
    assert tuple(got) == (2, new, dropped, 2 + new)
    assert merge_labeled(existing, fresh, strict).count() == got.merged_rows


def test_distribution_leaves_nulls_out_and_sorts(spark):
    got = [tuple(r) for r in class_distribution(records(spark, OLD + NEW)).collect()]
    assert got[:3] == [("category_id", "EXC", 5), ("category_id", "3", 2), ("category_id", "1", 1)]
    assert ("function_type", "A", 1) in got
    assert all(value is not None for _, value, _ in got)


def test_contract(spark):
    df = records(spark, [("a", "x", "A"), ("b", "9", "E"), ("c", None, " "), ("d", "EXC", None), ("e", "7", "D")])
    df = df.selectExpr("* EXCEPT (is_boundary_case)", "app_id IN ('a', 'e') AS is_boundary_case")
    got = dict(tuple(r) for r in label_contract(df).collect())
    assert got == {
        "category_missing": 1, "category_not_integer": 1, "category_outside_guide": 1,
        "function_missing": 2, "function_unknown": 1, "boundary_without_note": 2,
    }
    assert rows(function_violations(df)) == [(" ", 1), ("E", 1), (None, 1)]
    assert rows(boundary_report(df)) == [("7", 1, 1), ("x", 1, 1)]
    with pytest.raises(ValueError, match="category_missing: 1 rows"):
        assert_trainable(df)
    assert_trainable(records(spark, OLD))
