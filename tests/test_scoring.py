import numpy as np
import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from checks import views as V
from labelflow.operators.review import (
    confidence_summary,
    first_rows,
    flag_counts,
    review_order,
    review_top,
)
from labelflow.operators.scoring import (
    batch_logits,
    linear_heads,
    with_keyword_flags,
    with_logits,
    with_predictions,
)
from labelflow.plans.prelabel import prelabel
from labelflow.schema import AUDIT_COLUMNS

HEADS = ([[1.0, 0.0], [0.0, 1.0], [0.0, 0.0]], [0.0, 0.0, 0.5], [[1.0, 1.0], [-1.0, 0.0]], [0.0, 0.0])


def vectors(spark):
    return spark.createDataFrame(
        [(1, [2.0, 0.0]), (2, [0.0, 3.0]), (3, None), (4, [0.0, 0.0])], "id int, x array<float>"
    )


def test_logits_and_predictions(spark):
    scored = with_predictions(
        with_logits(vectors(spark), linear_heads(*HEADS), "x", widths=[2]),
        categories=[4, 6, 7], functions=["B", "C"],
    )
    got = {r.id: r for r in scored.collect()}
    x = np.array([2.0, 0.0, 0.5])
    assert got[1].category_confidence == pytest.approx(np.exp(2.0) / np.exp(x).sum())
    assert (got[1].predicted_category_id, got[1].predicted_category_name) == (4, "만성질환")
    assert (got[2].predicted_category_id, got[2].predicted_function_type) == (6, "B")
    assert got[2].predicted_function_name == "데이터기록관리"
    assert got[4].predicted_category_id == 7
    assert got[4].function_pred == 0 and got[4].function_confidence == 0.5
    assert got[4].min_confidence == min(got[4].category_confidence, 0.5)
    assert got[3].predicted_category_id is None and got[3].min_confidence is None
    assert got[3].predicted_category_name == ""


def test_text_models_score_in_batches(spark):
    def load():
        import numpy as np

        def predict(texts):
            n = np.array([[float(len(t)), 0.0] for t in texts])
            return {"category": n, "function": -n}

        return predict

    df = spark.createDataFrame([("ab",), ("",), (None,)], "t string")
    got = {r.t: r.s for r in df.withColumn("s", batch_logits(load, F.col("t"))).collect()}
    assert got["ab"].category == [2.0, 0.0] and got["ab"].function == [-2.0, 0.0]
    assert got[""].category == [0.0, 0.0]
    assert got[None] is None


def test_models_with_two_inputs(spark):
    """Token numbers and their mask, as an encoder takes them."""
    def load():
        def predict(ids, mask):
            total = (ids * mask).sum(axis=1, keepdims=True).astype("float64")
            return {"category": total, "function": -total}

        return predict

    df = spark.createDataFrame(
        [([1, 2, 9], [1, 1, 0]), (None, [0, 0, 0])], "ids array<int>, mask array<int>"
    )
    got = with_logits(df, load, "ids", "mask", widths=[3, 3]).collect()
    assert got[0].category_logits == [3.0] and got[0].function_logits == [-3.0]
    assert got[1].category_logits is None


def test_the_model_runs_once_under_filters_and_joins(spark):
    scored = with_predictions(with_logits(V.vectors(spark, SMALL), linear_heads(*V.HEADS), "embedding", widths=[64]))
    query = scored.filter("min_confidence < 0.5 AND predicted_category_id > 2").groupBy("category_pred").count()
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_softmax_is_not_repeated_per_use(spark):
    scored = with_predictions(with_logits(V.vectors(spark, SMALL), linear_heads(*V.HEADS), "embedding", widths=[64]))
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("EXP(") == 2


def queue(spark):
    return spark.createDataFrame(
        [("a", 0.9, ""), ("b", None, "g"), ("c", float("nan"), ""), ("d", 0.2, "g,h"), ("e", 0.2, None), ("f", 0.1, "")],
        "app_id string, min_confidence double, minority_candidate string",
    )


def test_queue_order(spark):
    assert [r.app_id for r in review_order(queue(spark)).collect()] == list("fdeacb")
    assert [r.app_id for r in review_top(queue(spark), 2).collect()] == ["f", "d"]
    assert [r.app_id for r in review_top(queue(spark), 4, minority_first=True).collect()] == list("dbfe")
    assert [r.app_id for r in first_rows(queue(spark), 3, "app_id").collect()] == list("abc")
    plan = review_top(queue(spark), 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_equal_confidences_sort_over_several_ranges(spark):
    df = spark.range(0, 20_000, 1, 8).selectExpr("'same' AS app_id", "1.0D AS min_confidence", "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = review_order(df).rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 20_000 and max(sizes) < 20_000


def test_summary_and_flag_counts(spark):
    df = queue(spark).selectExpr("*", "0.5D AS category_confidence", "min_confidence AS function_confidence")
    got = confidence_summary(df.filter("app_id <> 'c'")).first()
    assert (got.n, got.mean_category_confidence, got.minority_candidates) == (5, 0.5, 2)
    assert got.mean_function_confidence == pytest.approx((0.9 + 0.2 + 0.2 + 0.1) / 4)
    assert rows(flag_counts(df)) == [("g", 2), ("h", 1)]


def test_flags_read_description_and_name(spark):
    df = spark.createDataFrame([("x", "DNA"), (None, "skin"), ("beauty", None), (None, None)], "description string, app_name string")
    assert [r.minority_candidate for r in with_keyword_flags(df).collect()] == ["유전자", "미용", "미용", ""]


def test_prelabel_adds_exactly_the_audit_columns(spark):
    records = V.apps(spark, SMALL)

    def load():
        import numpy as np

        def predict(texts):
            n = np.array([len(t) for t in texts], dtype="float64")
            return {"category": np.stack([np.sin(n * (c + 1)) for c in range(8)], axis=1),
                    "function": np.stack([np.cos(n * (c + 1)) for c in range(4)], axis=1)}

        return predict

    out = prelabel(records, lambda df: with_logits(df, load, "combined_text"))
    assert set(out.queue.columns) == {*records.columns, *AUDIT_COLUMNS}
    confidences = [r.min_confidence for r in out.queue.select("min_confidence").collect()]
    assert confidences == sorted(confidences) and len(confidences) == records.count()
    assert out.summary.first().n == len(confidences)
    narrow = prelabel(records, lambda df: with_logits(df, load, "combined_text"), ["app_id"])
    assert narrow.queue.columns == ["app_id", *AUDIT_COLUMNS]
    # The queue and the summary read the written scores, not the model.
    assert "ArrowEvalPython" not in out.queue._jdf.queryExecution().executedPlan().toString()
