import pytest
from conftest import SMALL

import __spark_entry__ as driver
from checks import queries as Q
from checks.compare import connect, differences
from checks.oracle import ORACLE


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(Q.QUERIES) == set(ORACLE)
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert differences(spark, con, name, SMALL) == ""


def test_the_comparison_sees_a_changed_value(spark, con, monkeypatch):
    original = Q.QUERIES["class_report"]
    changed = lambda s, d: original(s, d).selectExpr("* EXCEPT (hits)", "hits + 1 AS hits")
    monkeypatch.setitem(Q.QUERIES, "class_report", changed)
    assert differences(spark, con, "class_report", SMALL).startswith("column hits")


def test_entry(spark):
    got = driver.entry(spark)
    assert got.count() == 100
    assert got.columns[0] == "vec_id"


def test_text_heads_beat_the_majority_class(spark):
    held_out = Q.two_heads_scored(spark, "/root/testdata/sf0.1").filter("NOT is_train")
    predicted = Q.scoring.with_predictions(held_out, [0, 1], ["0", "1"])
    report = Q.metrics.class_report(Q.metrics.confusion(predicted, Q.VECTOR_AXES))
    got = {r.axis: r for r in Q.metrics.report_summary(report).collect()}
    # Always answering the larger class gives a macro F1 of 0.47 on both axes.
    assert got["category"].macro_f1 > 0.6 and got["function"].macro_f1 > 0.55
