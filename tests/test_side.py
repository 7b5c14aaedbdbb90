"""How often the commands read their input, and that the side table tells the same as the records."""

import pytest
from conftest import SMALL, rows

import labelflow.__main__ as cli
from checks import views as V
from labelflow.operators import contract, encode, merge, side
from labelflow.plans import merge as merge_plan
from labelflow.plans import train
from labelflow.sinks.records import write_records


def counted(df):
    """The rows of `df`, and an accumulator of how many of them were read."""
    seen = df.sparkSession.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return df.mapInArrow(run, df.schema), seen


def known(spark):
    return V.apps(spark, SMALL).filter("category_id IS NOT NULL")


def test_the_side_table_tells_what_the_records_tell(spark):
    records = V.apps(spark, SMALL)
    narrow = side.label_side(records, "app_id")
    for of in (contract.label_contract, contract.boundary_report, contract.function_violations,
               encode.category_dictionary, merge.class_distribution):
        assert rows(of(narrow)) == rows(of(records))
    for strict in (False, True):
        pair = V.halves(spark, SMALL)
        assert rows(side.counts_of_merge(side.merge_side(*pair, strict))) == rows(merge.merge_counts(*pair, strict))


def test_prepare_reads_twice_and_splits_alike(spark):
    records, seen = counted(known(spark))
    n = known(spark).count()
    prepared = train.prepare(records)
    assert seen.value == 2 * n
    want = {r.app_id: r.is_train for r in train.stratified_split(known(spark), "app_id", "category_id").collect()}
    assert {r.app_id: r.is_train for r in prepared.collect()} == want


def test_prepare_single_axis_reads_twice(spark):
    records, seen = counted(known(spark))
    train.prepare_single_axis(records)
    assert seen.value == 2 * known(spark).count()


def test_merge_reads_each_side_twice(spark, tmp_path):
    (old, seen_old), (new, seen_new) = map(counted, V.halves(spark, SMALL))
    merged = merge_plan.merge(old, new, str(tmp_path / "out"))
    assert merged.counts.merged_rows == 192
    assert rows(merged.distribution) == rows(merge.class_distribution(merge.merge_labeled(*V.halves(spark, SMALL))))
    n_old, n_new = (half.count() for half in V.halves(spark, SMALL))
    assert (seen_old.value, seen_new.value) == (2 * n_old, 2 * n_new)


@pytest.mark.parametrize("command", ["train", "evaluate", "train-weighted"])
def test_commands_read_their_data_twice(spark, tmp_path_factory, monkeypatch, command):
    base = tmp_path_factory.mktemp("side")
    write_records(known(spark), f"{base}/records")
    if command == "evaluate":
        cli.main(["train", "--data", f"{base}/records", "--model", f"{base}/m"])
    seen = []

    def read(spark, path):
        df, acc = counted(spark.read.parquet(path))
        seen.append(acc)
        return df

    monkeypatch.setattr(cli, "_read", read)
    cli.main([command, "--data", f"{base}/records", "--model", f"{base}/m",
              *(["--output", f"{base}/report"] if command == "evaluate" else [])])
    assert [a.value for a in seen] == [2 * known(spark).count()]
