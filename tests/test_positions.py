import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from labelflow.operators import positions
from labelflow.operators.scoring import with_logits
from labelflow.plans.prelabel import prelabel
from labelflow.schema import CANONICAL_COLUMNS

SCHEMA = "app_id string, min_confidence double, minority_candidate string, text string"


def scored(spark, n=500, seed=3):
    r = random.Random(seed)
    data = [(f"a{r.randrange(n // 2)}", r.choice([None, 0.1, 0.2, 0.2, round(r.random(), 2)]),
             r.choice([None, "", "", "g1"]), f"text {i}") for i in range(n)]
    data += [("a1", 0.2, "", "same")] * (n // 3)  # a third of the rows under one key, all equal
    return data, spark.createDataFrame(data, SCHEMA).repartition(7)


@pytest.mark.parametrize("minority_first", [False, True])
def test_positions_are_the_places_of_a_sorted_table(spark, minority_first):
    data, df = scored(spark)
    got = positions.review_positions(df, minority_first=minority_first).orderBy("position").collect()
    assert [r.position for r in got] == list(range(1, len(data) + 1))
    rank = lambda d: (minority_first and not d[2], d[1] is None, d[1] or 0, d[0])
    assert [rank(tuple(r)[:4]) for r in got] == sorted(rank(d) for d in data)
    assert sorted(map(repr, (tuple(r)[:4] for r in got))) == sorted(map(repr, data))


def test_no_rows_and_clashing_names(spark):
    _, df = scored(spark, 30)
    assert positions.review_positions(df.limit(0)).count() == 0
    clash = df.withColumn("_row", F.lit("mine"))
    got = positions.review_positions(clash)
    assert got.columns == [*clash.columns, "position"]
    assert {r._row for r in got.collect()} == {"mine"}


def test_wide_columns_are_in_no_sort(spark):
    _, df = scored(spark, 60)
    plan = positions.review_positions(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort " not in plan  # the narrow rows were sorted and written before


def test_ranges_follow_each_other(spark):
    data, df = scored(spark)
    dealt = positions.in_ranges(positions.review_positions(df), len(data), 100)
    parts = dealt.rdd.mapPartitions(lambda p: [[r.position for r in p]]).collect()
    assert len(parts) == -(-len(data) // 100)
    assert [x for p in parts for x in p] == list(range(1, len(data) + 1))


def records(spark):
    return spark.range(50).selectExpr(
        *["CASE WHEN id % 5 = 0 THEN 'a dna test' ELSE 'x' END AS description" if c == "description"
          else "concat('app', id) AS app_id" if c == "app_id"
          else "false AS is_boundary_case" if c == "is_boundary_case"
          else f"'{c}' AS {c}" for c in CANONICAL_COLUMNS])


def test_prelabel_options(spark):
    def load():
        import numpy as np

        def predict(texts):
            n = np.array([len(t) for t in texts], dtype=float)
            return {"category": np.stack([n * 0, n], 1), "function": np.stack([n, n * 0], 1)}
        return predict

    score = lambda df: with_logits(df, load, "combined_text")
    whole, summary = prelabel(records(spark), score)
    assert whole.count() == 50 and summary.first().n == 50
    order = [(r.min_confidence, r.app_id) for r in whole.collect()]
    assert order == sorted(order)
    top, summary = prelabel(records(spark), score, carry=["app_id"], top=12, minority_first=True)
    got = top.collect()
    assert top.columns[0] == "app_id" and "description" not in top.columns
    assert [bool(r.minority_candidate) for r in got] == [True] * 10 + [False] * 2
    assert summary.first().n == 50
    bare, _ = prelabel(records(spark), score, carry=["genre"])
    assert "app_id" not in bare.columns and rows(bare.select("genre").distinct()) == [("genre",)]
