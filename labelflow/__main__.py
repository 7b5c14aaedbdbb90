"""Command line: `python -m labelflow <collect|check|prelabel|merge|train|train-weighted|evaluate|runs> ...`

Submit it to a cluster with `spark-submit --py-files labelflow.zip labelflow/__main__.py ...`.
Record tables are Parquet; a path that ends in `.csv` is read or written as CSV.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelflow.operators.contract import boundary_report, function_violations, label_contract
from labelflow.operators.encode import category_dictionary
from labelflow.operators.heads import score_heads
from labelflow.operators.metrics import report_summary, whole_report
from labelflow.operators.review import first_rows
from labelflow.operators.side import label_side
from labelflow.operators.runlog import best_checkpoints, rank_runs, with_logged_best
from labelflow.operators.split import split_preconditions
from labelflow.operators.truncation import truncation_audit, with_token_count
from labelflow.plans import collect, merge, prelabel, train
from labelflow.plans.prelabel import with_combined_text
from labelflow.schema import (
    DEFAULT_HITS_PER_KEYWORD,
    DEFAULT_PATIENCE,
    DEFAULT_SEED,
    DEFAULT_TEST_SIZE,
    REPORT_SECTIONS,
    REPORT_SLICE_NAMES,
    REPORT_SLICES,
    SEARCH_KEYWORDS,
)
from labelflow.session import session
from labelflow.sinks.models import label_config, model_settings, save_model
from labelflow.sinks.records import write_collected_csv, write_records, write_records_csv
from labelflow.scale import cleaned_scratch, materialize
from labelflow.sinks.reports import write_report_text
from labelflow.sources.keywords import read_keywords
from labelflow.sources.models import (
    check_dictionary,
    check_split,
    load_model,
    read_label_config,
    read_settings,
)
from labelflow.sources.records import read_records, read_records_csv, rejected_cells
from labelflow.sources.runlogs import parse_any, parse_events, read_log_text


def _read(spark: SparkSession, path: str) -> DataFrame:
    return (read_records_csv if path.endswith(".csv") else read_records)(spark, path)


def _write(df: DataFrame, path: str) -> None:
    """CSV for reviewers has a byte-order mark."""
    if path.endswith(".csv"):
        write_records_csv(df, path, byte_order_mark=True)
    else:
        write_records(df, path)


def run_collect(spark: SparkSession, args: argparse.Namespace) -> None:
    keywords = read_keywords(spark, args.keywords_file) if args.keywords_file else SEARCH_KEYWORDS
    texts = spark.read.parquet(args.texts)
    found = collect.find_candidates(texts, args.id, F.col(args.text), keywords, args.n_hits)
    details = spark.read.parquet(args.details)
    records, missing = collect.collect_records(found, details, args.lang, args.country)
    ordered = collect.in_discovery_order(records, found)
    if args.output.endswith(".csv"):
        write_collected_csv(ordered, args.output, byte_order_mark=True)
    else:
        write_records(ordered, args.output)
    missing = materialize(missing, "missing")
    missing_path = args.output.removesuffix(".csv") + "-missing"
    missing.write.csv(missing_path, header=True)
    print(f"candidates: {found.count()}, without details: {missing.count()}, listed in {missing_path}")


def run_prelabel(spark: SparkSession, args: argparse.Namespace) -> None:
    records = _read(spark, args.input)
    if args.limit:
        records = first_rows(records, args.limit, "app_id")
    config = read_label_config(spark, args.model)
    model = load_model(args.model)
    queue, summary = prelabel.prelabel(
        records, lambda df: score_heads(model, df),
        categories=config.categories, functions=config.functions,
        category_names=config.category_names, function_names=config.function_names,
        carry=args.carry and args.carry.split(","), top=args.top, minority_first=args.minority_first,
    )
    _write(queue, args.output)
    summary.show(truncate=False)


def run_merge(spark: SparkSession, args: argparse.Namespace) -> None:
    merged = merge.merge(
        _read(spark, args.existing), _read(spark, args.new), args.output,
        strict=args.strict_exclude_exc, as_csv=args.output.endswith(".csv"),
    )
    n = merged.counts
    print(
        f"existing {n.existing_rows} + new {n.new_rows} = merged {n.merged_rows}, "
        f"left out {n.dropped_rows}"
    )
    # Every value, in a file; the screen gets the same rows, fetched part by part.
    distribution = materialize(merged.distribution, "distribution")
    distribution.write.csv(args.output.removesuffix(".csv") + "-distribution", header=True)
    for row in distribution.toLocalIterator():
        print("\t".join(str(v) for v in row))


def run_check(spark: SparkSession, args: argparse.Namespace) -> None:
    """Contract, unknown codes, boundary cases, split preconditions and, for CSV, rejected cells."""
    records = _read(spark, args.data)
    side = label_side(records, args.key)
    counts = side.groupBy("category_id").agg(F.count("*").alias("n"))
    reports = {
        "contract": label_contract(side),
        "functions": function_violations(side),
        "boundary": boundary_report(side),
        "split": split_preconditions(counts, "category_id", args.test_size),
    }
    if args.data.endswith(".csv"):
        reports["rejected"] = rejected_cells(spark, args.data)
    if args.lengths:
        text = with_combined_text(records).select("category_id", "combined_text")
        lengths = [int(n) for n in args.lengths.split(",")]
        reports["truncation"] = truncation_audit(with_token_count(text, "combined_text"), "category_id", lengths)
    for name, report in reports.items():  # whole, in files; the screen shows their heads
        written = f"{args.output}/{name}"
        report.write.mode("overwrite").csv(written, header=True)
        print(name)
        spark.read.csv(written, header=True, schema=report.schema).show(truncate=False)


def run_train(spark: SparkSession, args: argparse.Namespace) -> None:
    records = _read(spark, args.data)
    side = label_side(records, args.key)
    prepared = train.prepare(records, args.key, args.test_size, args.seed, side=side)
    model = train.fit(prepared)
    settings = model_settings(prepared, args.key, args.test_size, args.seed)
    save_model(model, label_config(spark, train.categories_of(side)), args.model, settings)
    result = train.evaluate_heads(model, prepared, read_label_config(spark, args.model))
    result.summary.show(truncate=False)
    result.score.show()


def run_train_weighted(spark: SparkSession, args: argparse.Namespace) -> None:
    records = _read(spark, args.data)
    side = label_side(records, args.key)
    prepared = train.prepare_single_axis(records, args.key, args.test_size, args.seed, side)
    model = train.fit_weighted(prepared)
    settings = model_settings(prepared, args.key, args.test_size, args.seed)
    save_model(model, label_config(spark, train.categories_of(side), {}), args.model, settings)
    report_summary(train.evaluate_weighted_head(model, prepared)).show(truncate=False)


def run_evaluate(spark: SparkSession, args: argparse.Namespace) -> None:
    config = read_label_config(spark, args.model)
    records = _read(spark, args.data)
    side = label_side(records, args.key)
    check_dictionary(category_dictionary(side), config)
    stored = spark.createDataFrame(
        [(c, i) for i, c in enumerate(config.categories)], "category int, category_label int"
    )
    prepared = train.prepare(records, args.key, args.test_size, args.seed, stored, side)
    settings = read_settings(spark, args.model)
    if settings is not None and not args.other_split:
        check_split(settings, model_settings(prepared, args.key, args.test_size, args.seed))
    result = train.evaluate_heads(load_model(args.model), prepared, config)
    names = {
        "category": {i: config.category_names[c] for i, c in enumerate(config.categories)},
        "function": {i: f"{c}({config.function_names[c]})" for i, c in enumerate(config.functions)},
    }
    lines = whole_report(
        result.report, result.slices.filter("axis = 'function'"), REPORT_SECTIONS, REPORT_SLICES,
        REPORT_SLICE_NAMES, names)
    write_report_text(lines, args.output)
    result.slices.show(truncate=False)


def run_runs(spark: SparkSession, args: argparse.Namespace) -> None:
    logs = read_log_text(spark, args.logs)
    best = best_checkpoints(parse_any(logs), args.patience, "score")
    ranked = rank_runs(with_logged_best(best, parse_events(logs)))
    if args.output:  # the whole ranking; the screen shows its head
        ranked.coalesce(1).write.mode("overwrite").csv(args.output, header=True)
    ranked.show(args.show, truncate=False)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="labelflow", description="curation of two-axis labelled text")
    commands = top.add_subparsers(required=True)

    def command(name: str, run, **options: dict) -> None:
        sub = commands.add_parser(name)
        for flag, settings in options.items():
            sub.add_argument("--" + flag.replace("_", "-"), **settings)
        sub.set_defaults(run=run)

    need = {"required": True}
    split = {
        "key": {"default": "app_id"},
        "test_size": {"type": float, "default": DEFAULT_TEST_SIZE},
        "seed": {"type": int, "default": DEFAULT_SEED},
    }
    command("collect", run_collect, texts=need, details=need, output=need,
            id={"default": "app_id"}, text={"default": "text"},
            keywords_file={}, n_hits={"type": int, "default": DEFAULT_HITS_PER_KEYWORD},
            lang={"default": "ko"}, country={"default": "kr"})
    command("prelabel", run_prelabel, input=need, model=need, output=need, limit={"type": int},
            carry={"help": "record columns of the queue, comma-separated; all by default"},
            top={"type": int, "help": "only the first rows of the queue"},
            minority_first={"action": "store_true", "help": "rows with a keyword flag first"})
    command("merge", run_merge, existing=need, new=need, output=need,
            strict_exclude_exc={"action": "store_true"})
    command("train", run_train, data=need, model=need, **split)
    command("train-weighted", run_train_weighted, data=need, model=need, **split)
    command("evaluate", run_evaluate, data=need, model=need, output=need, **split,
            other_split={"action": "store_true", "help": "accept another split than the model's own"})
    command("check", run_check, data=need, output=need, key=split["key"], test_size=split["test_size"],
            lengths={"help": "model lengths for the truncation report, comma-separated"})
    command("runs", run_runs, logs=need, patience={"type": int, "default": DEFAULT_PATIENCE},
            show={"type": int, "default": 100}, output={"help": "CSV folder for the whole ranking"})
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = session()
    with cleaned_scratch(spark):
        args.run(spark, args)


if __name__ == "__main__":
    main()
