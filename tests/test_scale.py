import os
from types import SimpleNamespace

import pytest
from conftest import rows

from labelflow.scale import cleaned_scratch, dimension, materialize, scratch_dir


def test_small_tables_are_broadcast(spark):
    table = dimension(spark.range(50).selectExpr("id", "id * 2 AS twice"))
    plan = spark.range(1000).join(table, "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_larger_tables_keep_all_rows_without_a_hint(spark):
    table = dimension(spark.range(50).selectExpr("id", "id * 2 AS twice"), max_rows=10)
    assert rows(table) == sorted(((i, 2 * i) for i in range(50)), key=repr)
    assert "ResolvedHint" not in table._jdf.queryExecution().logical().toString()


def test_written_tables_lie_in_the_shared_folder(spark):
    table = materialize(spark.range(5).selectExpr("id", "array(id) AS a"))
    assert rows(table) == sorted(((i, [i]) for i in range(5)), key=repr)
    assert all(scratch_dir(spark) in f for f in table.inputFiles())


def fake_session(master, conf, checkpoint_dir=None):
    context = SimpleNamespace(
        master=master, applicationId="app", getCheckpointDir=lambda: checkpoint_dir
    )
    return SimpleNamespace(sparkContext=context, conf=conf)


def test_the_cluster_setting_wins():
    session = fake_session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/"}, "hdfs:///other")
    assert scratch_dir(session) == "hdfs:///shared/labelflow/app"


def test_no_machine_folder_on_a_cluster():
    assert scratch_dir(fake_session("yarn", {}, "hdfs:///other")) == "hdfs:///other/labelflow/app"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(fake_session("yarn", {}))


def test_written_tables_of_a_command_are_removed(spark):
    kept = materialize(spark.range(3), "kept")
    with pytest.raises(ZeroDivisionError), cleaned_scratch(spark):
        gone = materialize(spark.range(3), "gone").inputFiles()
        assert all(os.path.exists(f.removeprefix("file://")) for f in gone)
        1 / 0
    assert not any(os.path.exists(f.removeprefix("file://")) for f in gone)
    assert kept.count() == 3
