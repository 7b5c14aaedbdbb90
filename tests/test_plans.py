import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from checks import views as V
from labelflow.__main__ import main
from labelflow.operators.heads import predict_weighted_head, train_weighted_head
from labelflow.plans import train
from labelflow.schema import AUDIT_COLUMNS, CANONICAL_COLUMNS
from labelflow.sinks.models import label_config, save_model
from labelflow.sinks.records import write_records, write_records_csv
from labelflow.sources.models import check_dictionary, load_model, read_label_config
from labelflow.sources.records import read_records_csv


@pytest.fixture(scope="module")
def learnable(spark):
    """Records whose words tell their labels; every tenth one is a sentinel."""
    return spark.range(600).selectExpr(
        "'ios' AS platform", "'kr' AS country", "concat('app', id) AS app_id",
        "CASE WHEN id % 7 = 0 THEN NULL ELSE concat('name', id) END AS app_name",
        "concat('topic', id % 3, ' words word', id % 11) AS description", "'g' AS genre",
        "'' AS store_url", "'' AS idea_desc",
        "CASE WHEN id % 2 = 0 THEN 'records data' END AS collected_data",
        "CASE WHEN id % 10 = 9 THEN 'EXC' ELSE string(2 * (id % 3)) END AS category_id",
        "CASE WHEN id % 2 = 0 THEN 'B' ELSE 'D' END AS function_type",
        "false AS is_boundary_case", "'' AS note",
    )


@pytest.fixture(scope="module")
def model_dir(spark, learnable, tmp_path_factory):
    base = tmp_path_factory.mktemp("model")
    write_records(learnable, f"{base}/records")
    main(["train", "--data", f"{base}/records", "--model", f"{base}/out"])
    return base


def test_training_learns_both_axes(spark, learnable, model_dir):
    config = read_label_config(spark, f"{model_dir}/out")
    assert config.categories == [0, 2, 4] and config.functions == list("ABCD")
    prepared = train.prepare(learnable)
    assert prepared.filter("is_train").count() == 480
    result = train.evaluate_heads(load_model(f"{model_dir}/out"), prepared, config)
    assert result.score.first()[0] > 0.95
    assert {r.axis: r.support for r in result.summary.collect()} == {"category": 108, "function": 120}
    slices = {(r.axis, r.slice): r.n for r in result.slices.collect()}
    assert slices == {("function", "all"): 120, ("function", "real"): 108, ("function", "EXC"): 12}


def test_evaluate_command_writes_a_text_report(spark, model_dir, capsys):
    main(["evaluate", "--data", f"{model_dir}/records", "--model", f"{model_dir}/out", "--output", f"{model_dir}/report"])
    lines = [r.value for r in spark.read.text(f"{model_dir}/report").collect()]
    assert sum("accuracy" in line for line in lines) == 2
    assert any(line.strip().startswith("B(데이터기록관리)") for line in lines)
    assert "EXC" in capsys.readouterr().out


def test_prelabel_command(spark, model_dir):
    main(["prelabel", "--input", f"{model_dir}/records", "--model", f"{model_dir}/out",
          "--output", f"{model_dir}/queue.csv", "--limit", "40"])
    got = read_records_csv(spark, f"{model_dir}/queue.csv")
    assert got.columns == [*CANONICAL_COLUMNS, *AUDIT_COLUMNS]
    assert got.count() == 40
    assert dict(got.dtypes)["predicted_category_id"] == "int"
    assert {r.predicted_category_name for r in got.select("predicted_category_name").distinct().collect()} <= {"수면", "운동", "만성질환"}


def test_train_weighted_command(spark, model_dir, capsys):
    main(["train-weighted", "--data", f"{model_dir}/records", "--model", f"{model_dir}/weighted"])
    config = read_label_config(spark, f"{model_dir}/weighted")
    assert config.categories == [0, 2, 4] and config.functions == []
    out = capsys.readouterr().out
    assert "macro_f1" in out and "|108" in out


def test_a_category_unknown_to_the_model_is_an_error(spark, model_dir):
    config = read_label_config(spark, f"{model_dir}/out")
    check_dictionary(spark.createDataFrame([(4, 0)], "category int, category_label int"), config)
    with pytest.raises(ValueError, match="7"):
        check_dictionary(spark.createDataFrame([(7, 0)], "category int, category_label int"), config)


def test_untrainable_records_are_rejected(learnable):
    broken = learnable.withColumn("category_id", F.expr("CASE WHEN app_id = 'app1' THEN 'x' ELSE category_id END"))
    with pytest.raises(ValueError, match="category_not_integer: 1 rows"):
        train.prepare(broken)


def test_model_round_trip(spark, model_dir, tmp_path):
    model = load_model(f"{model_dir}/out")
    save_model(model, label_config(spark, [0, 7]), str(tmp_path / "again"))
    config = read_label_config(spark, str(tmp_path / "again"))
    assert config.categories == [0, 7] and config.category_names == {0: "수면", 7: "미용"}
    assert len(load_model(str(tmp_path / "again")).stages) == len(model.stages)


def test_weighted_head_lifts_a_rare_class(spark):
    data = spark.range(400).selectExpr(
        "array(cast(id % 20 = 0 AS float) + cast((id * 37 % 100) / 100 AS float), 1F) AS x",
        "cast(id % 20 = 0 AS int) AS y", "id",
    )
    model = train_weighted_head(data, "x", "y")
    hits = predict_weighted_head(model, data, "x").filter("y = 1 AND category_pred = 1").count()
    assert hits >= 18


def test_merge_command(spark, tmp_path, capsys):
    existing, new = V.halves(spark, SMALL)
    write_records(existing, str(tmp_path / "old"))
    write_records_csv(new, str(tmp_path / "new.csv"))
    main(["merge", "--existing", str(tmp_path / "old"), "--new", str(tmp_path / "new.csv"), "--output", str(tmp_path / "merged.csv")])
    merged = read_records_csv(spark, str(tmp_path / "merged.csv"))
    assert merged.columns == [*CANONICAL_COLUMNS, "labeled_by"]
    assert merged.count() == 200 - 8
    main(["merge", "--existing", str(tmp_path / "old"), "--new", str(tmp_path / "new.csv"), "--output", str(tmp_path / "strict"), "--strict-exclude-exc"])
    assert spark.read.parquet(str(tmp_path / "strict")).count() == 200 - 13
    assert "existing 67 + new 120 = merged 187, left out 13" in capsys.readouterr().out


def test_collect_command(spark, tmp_path):
    V.details(spark, SMALL).write.parquet(str(tmp_path / "details"))
    V.table(spark, SMALL, "documents").selectExpr("string(doc_id) AS app_id", "text").write.parquet(str(tmp_path / "texts"))
    (tmp_path / "kw.txt").write_text("les\n\n the \n", encoding="utf-8")
    main(["collect", "--texts", str(tmp_path / "texts"), "--details", str(tmp_path / "details"),
          "--keywords-file", str(tmp_path / "kw.txt"), "--n-hits", "20", "--output", str(tmp_path / "out.csv")])
    got = read_records_csv(spark, str(tmp_path / "out.csv"))
    assert got.columns == CANONICAL_COLUMNS
    assert 0 < got.count() <= 40
    assert rows(got.select("category_id").distinct()) == [(None,)]


def test_runs_command(spark, tmp_path, capsys):
    text = "\n".join(
        f"Epoch {e}/9 | Loss: 1.0 | [축1] Acc: 0.5 F1: {s} | [축2] Acc: 0.5 \nF1: {s} | Avg F1: {s}"
        for e, s in enumerate([0.1, 0.4, 0.3, 0.2], 1)
    )
    (tmp_path / "first.txt").write_text(text, encoding="utf-8")
    main(["runs", "--logs", str(tmp_path), "--patience", "2"])
    assert "|first.txt|1      |2   |4     |2         |0.4       |4         |NULL       |" in capsys.readouterr().out
    one = "\n".join(
        f"Epoch {e}/9 | Loss: 1.0 | Val Acc: 0.5 | Val Macro F1: {s}\n\u2728 [New Best] Large Model saved with Macro F1: {s}"
        for e, s in enumerate([0.1, 0.6], 1)
    )
    (tmp_path / "second.txt").write_text(text + "\n" + text + "\n" + one, encoding="utf-8")
    main(["runs", "--logs", str(tmp_path), "--patience", "9", "--show", "1", "--output", str(tmp_path / "ranking")])
    got = [tuple(r) for r in spark.read.csv(str(tmp_path / "ranking"), header=True).collect()]
    assert got == [
        ("second.txt", "1", "1", "2", "2", "0.6", None, "0.6"), ("first.txt", "1", "2", "4", "2", "0.4", None, None),
        ("second.txt", "1", "2", "4", "2", "0.4", None, "0.6"), ("second.txt", "2", "2", "4", "2", "0.4", None, "0.6"),
    ]
