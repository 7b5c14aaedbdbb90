"""Quarantine, split preconditions, whole report, byte-order mark, model settings and text models."""

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from labelflow.__main__ import main
from labelflow.operators import metrics, split
from labelflow.operators.scoring import _by_bytes, with_text_logits
from labelflow.schema import CANONICAL_COLUMNS
from labelflow.sinks.models import model_settings
from labelflow.sinks.records import write_records_csv
from labelflow.sources.models import check_split, read_settings
from labelflow.sources.records import read_records_csv, rejected_cells


def records(spark, n=60):
    special = {
        "app_id": "concat('app', id)", "category_id": "CASE WHEN id % 10 = 9 THEN 'EXC' ELSE string(id % 3) END",
        "function_type": "CASE WHEN id % 2 = 0 THEN 'A' ELSE 'C' END", "is_boundary_case": "id % 4 = 0",
        "description": "concat('topic', id % 3, ' \"quoted\", and\nmore')",
    }
    return spark.range(n).selectExpr(*[f"{special.get(c, repr(c))} AS {c}" for c in CANONICAL_COLUMNS])


def test_rejected_cells_are_counted_per_file(spark, tmp_path):
    header = "category_id,function_type,is_boundary_case,min_confidence,free"
    (tmp_path / "a.csv").write_text(header + "\n1,A,true,0.5,x\nsix,E,maybe,high,y\nsix,,NA,n/a,z\nEXC,A,false,1e-3,\n")
    (tmp_path / "b.csv").write_text("\ufeff" + header + "\nsix,A,TRUE,,x\n2.5,  ,no,1,y\n", encoding="utf-8")
    got = rows(rejected_cells(spark, str(tmp_path)).withColumn("file", F.regexp_extract("file", "[^/]*$", 0)))
    assert got == sorted([
        ("a.csv", "category_id", "six", 2), ("a.csv", "function_type", "E", 1), ("a.csv", "is_boundary_case", "maybe", 1),
        ("a.csv", "min_confidence", "high", 1), ("b.csv", "category_id", "six", 1), ("b.csv", "category_id", "2.5", 1),
    ], key=repr)


def test_byte_order_mark_round_trip(spark, tmp_path):
    path = str(tmp_path / "marked.csv")
    write_records_csv(records(spark), path, byte_order_mark=True)
    files = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert files and all(open(f"{path}/{f}", "rb").read(3) == b"\xef\xbb\xbf" for f in files)
    got = read_records_csv(spark, path)
    assert got.columns == CANONICAL_COLUMNS
    assert rows(got) == rows(records(spark))


@pytest.mark.parametrize("sizes, test_size, expected", [
    ({"a": 10, "b": 10}, 0.2, []),
    ({"a": 10, "b": 1}, 0.2, [("class_too_small", "b", 1, 2)]),
    ({"a": 10, None: 3}, 0.2, [("class_missing", None, 3, 0)]),
    ({"a": 4, "b": 4, "c": 4}, 0.1, [("no_room_for_test", None, 2, 3)]),
    ({"a": 4, "b": 4, "c": 4}, 0.9, [("no_room_for_training", None, 1, 3)]),
    ({}, 0.2, []),
])
def test_split_preconditions(spark, sizes, test_size, expected):
    counts = spark.createDataFrame(list(sizes.items()), "label string, n long")
    got = rows(split.split_preconditions(counts, "label", test_size))
    assert got == sorted(expected, key=repr)
    table = counts.select("label", F.expr("explode(array_repeat(1, cast(n AS int)))").alias("x"))
    if expected:  # the split itself refuses the same
        with pytest.raises(ValueError):
            split.stratified_split(table, "x", "label", test_size)


def test_whole_report_lines(spark):
    counts = spark.createDataFrame(
        [("one", 0, 0, 8), ("one", 0, 1, 2), ("one", 1, 1, 5), ("two", 3, 3, 4)], "axis string, truth int, predicted int, n long")
    slices = spark.createDataFrame([("two", "real", 3, 0.5), ("two", "other", 9, 0.1)], "axis string, slice string, n long, macro_f1 double")
    lines = metrics.whole_report(
        metrics.class_report(counts), slices, [("two", "== second =="), ("one", "== first ==")], "== slices ==",
        [("EXC", "none here"), ("real", "the real ones")], {"one": {0: "a name of some length", 1: "수면"}})
    got = [r.line for r in lines.orderBy("line_no").collect()]
    assert got[0] == "== second ==" and got[9] == "== first =="
    assert got[1] == " " * 12 + "  precision    recall  f1-score   support"
    assert got[3] == " " * 11 + "3       1.00      1.00      1.00         4"
    assert got[12] == "a name of some length       1.00      0.80      0.89        10"
    assert got[13] == " " * 19 + "수면       0.71      1.00      0.83         5"
    assert got[15] == " " * 13 + "accuracy                           0.87        15"
    assert got[2] == got[4] == got[8] == got[14] == ""
    assert got[-2:] == ["== slices ==", "[the real ones] n=3, macro F1=0.5000"]


def prepared(spark, n=60):
    return split.stratified_split(records(spark, n), "app_id", "category_id")


def test_settings_tell_splits_apart(spark):
    own = model_settings(prepared(spark), "app_id", 0.2, 42)
    check_split(own, model_settings(prepared(spark).repartition(3), "app_id", 0.2, 42, max_iter=9))
    moved = prepared(spark).withColumn("is_train", F.expr("CASE WHEN app_id = 'app0' THEN NOT is_train ELSE is_train END"))
    for other in (model_settings(prepared(spark, 61), "app_id", 0.2, 42), model_settings(moved, "app_id", 0.2, 42),
                  model_settings(split.stratified_split(records(spark), "app_id", "category_id", seed=1), "app_id", 0.2, 1)):
        with pytest.raises(ValueError, match="another split"):
            check_split(own, other)
    twice = prepared(spark).unionAll(prepared(spark))
    assert split.split_hash(twice, "app_id", "category_id") not in (own["split_hash"], "0")


def test_evaluate_refuses_another_split(spark, tmp_path):
    data, model = str(tmp_path / "data"), str(tmp_path / "model")
    records(spark).write.parquet(data)
    main(["train", "--data", data, "--model", model])
    assert read_settings(spark, model)["seed"] == "42"
    main(["evaluate", "--data", data, "--model", model, "--output", f"{model}/report"])
    with pytest.raises(ValueError, match="seed was 42, is 7"):
        main(["evaluate", "--data", data, "--model", model, "--output", f"{model}/report", "--seed", "7"])
    main(["evaluate", "--data", data, "--model", model, "--output", f"{model}/report", "--seed", "7", "--other-split"])
    assert read_settings(spark, str(tmp_path)) is None


def test_check_command_writes_whole_reports(spark, tmp_path, capsys):
    bad = records(spark).withColumn("category_id", F.expr("CASE WHEN app_id = 'app3' THEN 'x' ELSE category_id END"))
    write_records_csv(bad, str(tmp_path / "data.csv"))
    main(["check", "--data", str(tmp_path / "data.csv"), "--output", str(tmp_path / "out"), "--lengths", "4,512"])
    read = lambda name: rows(spark.read.csv(str(tmp_path / "out" / name), header=True).drop("file"))
    assert ("category_not_integer", "1") in read("contract")
    assert ("class_too_small", "x", "1", "2") in read("split")
    assert read("rejected") == [("category_id", "x", "1")]
    assert len(read("truncation")) == 2 * 5
    assert "boundary" in capsys.readouterr().out


def test_texts_in_batches_of_bytes(spark):
    import pyarrow as pa

    texts = pa.array(["aa", "b" * 9, "", "c", "é" * 3, "dd"])
    assert [p.to_pylist() for p in _by_bytes(texts, 8)] == [["aa"], ["b" * 9], ["", "c", "é" * 3], ["dd"]]
    assert list(_by_bytes(pa.array([], pa.string()), 8)) == []

    def load():
        def predict(texts):
            assert len(texts) == 1 or sum(len(t.encode()) for t in texts) <= 40
            n = [float(len(t)) for t in texts]
            return {"category": [[x, 1.0] for x in n], "function": [[len(texts), x] for x in n]}
        return predict

    df = spark.range(300).selectExpr("id", "CASE WHEN id = 7 THEN NULL ELSE repeat('x', cast(id % 60 AS int)) END AS combined_text")
    got = with_text_logits(df, load, batch_bytes=40).collect()
    assert len(got) == 300
    for r in got:
        assert r.category_logits == (None if r.id == 7 else [float(r.id % 60), 1.0])
