"""One query per operator of the inventory, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views as V
from labelflow.functions.codes import lookup, lookup_or_blank
from labelflow.functions.text import combined_text
from labelflow.functions.vectors import linear_logits, softmax
from labelflow.operators import (
    candidates,
    contract,
    details,
    encode,
    heads,
    keyword_join,
    losses,
    merge,
    metrics,
    positions,
    review,
    runlog,
    scoring,
    split,
    truncation,
)
from labelflow.plans import collect, prelabel
from labelflow.scale import materialize, scratch_path
from labelflow.schema import CATEGORY_NAMES, FUNCTION_INDEX, FUNCTION_NAMES
from labelflow.sinks import models as models_out
from labelflow.sinks.records import write_collected_csv, write_records_csv
from labelflow.sinks.runlogs import format_epochs, format_one_axis_epochs
from labelflow.sources import models as models_in
from labelflow.sources import records
from labelflow.sources.keywords import keyword_table
from labelflow.sources.records import read_records_csv
from labelflow.sources.runlogs import parse_any, parse_epochs, parse_segments

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, since sums of doubles depend on their order in the last digits."""
    return df.select([
        F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes
    ])


# Scoring and review ---------------------------------------------------------------------------

AUDIT = [
    "predicted_category_id", "predicted_category_name",
    "predicted_function_type", "predicted_function_name",
    "category_confidence", "function_confidence", "min_confidence",
]


def _with_logits(df: DataFrame) -> DataFrame:
    return scoring.with_logits(df, scoring.linear_heads(*V.HEADS), "embedding", widths=[V.WIDTH])


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scoring.with_predictions(_with_logits(V.vectors(spark, sf_dir)))
    # Rounded before any ordering, so that ties are ties on both sides of the check.
    return scored.withColumns({
        c: F.round(c, 6) for c in ("category_confidence", "function_confidence", "min_confidence")
    })


def _prelabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the scores of their vector (null without one) and keyword flags."""
    documents = V.apps(spark, sf_dir).select("app_id", "app_name", "description")
    # The flags replace the text before the join, which then moves narrow rows only.
    flagged = scoring.with_keyword_flags(documents, groups=V.GROUPS).drop("description")
    scores = _scored(spark, sf_dir).select(F.col("vec_id").cast("string").alias("app_id"), *AUDIT)
    return flagged.join(scores, "app_id", "left")


@query
def review_queue_topk(spark, sf_dir):
    scored = _scored(spark, sf_dir).select(
        "vec_id", F.col("category_pred").alias("category"), F.col("function_pred").alias("function"),
        "category_confidence", "function_confidence", "min_confidence",
    )
    return review.review_top(scored, 100, key="vec_id")


@query
def review_queue(spark, sf_dir):
    """The whole queue, scored once and then sorted."""
    scored = _scored(spark, sf_dir).select("vec_id", "min_confidence", "predicted_category_id")
    return review.review_order(materialize(scored, "scored"), key="vec_id")


@query
def review_positions(spark, sf_dir):
    """The place of every pre-labelled record in the queue; the texts are in no sort."""
    documents = V.apps(spark, sf_dir).select("app_id", "app_name", "description")
    flagged = scoring.with_keyword_flags(documents, groups=V.GROUPS)
    scores = _scored(spark, sf_dir).select(F.col("vec_id").cast("string").alias("app_id"), "min_confidence")
    placed = positions.review_positions(flagged.join(scores, "app_id", "left"), minority_first=True)
    return placed.select("position", "app_id", "min_confidence", F.char_length("description").alias("chars"))


@query
def review_queue_minority_first(spark, sf_dir):
    return review.review_top(_prelabelled(spark, sf_dir), 100, minority_first=True)


@query
def prelabel_records(spark, sf_dir):
    return _prelabelled(spark, sf_dir)


def _text_model() -> dict[str, list[list[float]]]:
    """A model of whole texts: logits out of their length in bytes."""
    def predict(texts: list[str]):
        lengths = [len(t.encode()) for t in texts]
        return {
            "category": [[n * (c + 3) % 17 / 10 for c in range(8)] for n in lengths],
            "function": [[n * (c + 5) % 11 / 10 for c in range(4)] for n in lengths],
        }

    return predict


@query
def prelabel_plan(spark, sf_dir):
    """The whole plan with a model of texts."""
    queue, _ = prelabel.prelabel(
        V.apps(spark, sf_dir), lambda df: scoring.with_text_logits(df, _text_model), carry=["app_id", "category_id"])
    return rounded(queue)


@query
def score_two_axis(spark, sf_dir):
    return _scored(spark, sf_dir).select("vec_id", *AUDIT)


@query
def score_native_heads(spark, sf_dir):
    """The same heads as array expressions, without a Python worker."""
    wc, bc, wf, bf = V.HEADS
    logits = V.vectors(spark, sf_dir).select(
        "vec_id",
        linear_logits(F.col("embedding"), wc, bc).alias("category_logits"),
        linear_logits(F.col("embedding"), wf, bf).alias("function_logits"),
    )
    return rounded(scoring.with_predictions(logits).select("vec_id", *AUDIT))


@query
def score_first_n(spark, sf_dir):
    first = review.first_rows(V.vectors(spark, sf_dir), 50, "vec_id")
    return rounded(scoring.with_predictions(_with_logits(first)).select("vec_id", *AUDIT))


@query
def confidence_summary(spark, sf_dir):
    return rounded(review.confidence_summary(_prelabelled(spark, sf_dir)))


@query
def minority_flag_counts(spark, sf_dir):
    flagged = scoring.with_keyword_flags(V.apps(spark, sf_dir), groups=V.GROUPS)
    return review.flag_counts(flagged)


# Merge and label checks -----------------------------------------------------------------------

@query
def merge_labeled(spark, sf_dir):
    return merge.merge_labeled(*V.halves(spark, sf_dir))


@query
def merge_strict(spark, sf_dir):
    return merge.merge_labeled(*V.halves(spark, sf_dir), strict=True)


@query
def merge_counts(spark, sf_dir):
    return merge.merge_counts(*V.halves(spark, sf_dir))


@query
def merge_counts_strict(spark, sf_dir):
    return merge.merge_counts(*V.halves(spark, sf_dir), strict=True)


@query
def class_distribution(spark, sf_dir):
    return merge.class_distribution(merge.merge_labeled(*V.halves(spark, sf_dir)))


@query
def label_contract(spark, sf_dir):
    return contract.label_contract(V.apps(spark, sf_dir))


@query
def function_violations(spark, sf_dir):
    return contract.function_violations(V.apps(spark, sf_dir))


@query
def boundary_report(spark, sf_dir):
    return contract.boundary_report(V.apps(spark, sf_dir))


# Records and text -----------------------------------------------------------------------------

@query
def records_csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "records-csv")
    write_collected_csv(V.apps(spark, sf_dir), path)
    return read_records_csv(spark, path)


@query
def rejected_cells(spark, sf_dir):
    """Two CSV folders of records with cells of other types; the file's folder stands for its name."""
    path = scratch_path(spark, "records-csv")
    documents = V.table(spark, sf_dir, "documents")
    for part in (0, 1):
        half = V.view(documents.filter(F.col("doc_id") % 2 == part), V.BAD_CELLS)
        write_records_csv(half, f"{path}/half{part}", byte_order_mark=part == 1)
    found = [records.rejected_cells(spark, f"{path}/half{part}") for part in (0, 1)]
    folder = F.regexp_extract("file", "/(half[01])/[^/]*$", 1)
    return found[0].unionAll(found[1]).groupBy(folder.alias("folder"), "column", "value").agg(F.sum("n").alias("n"))


@query
def normalize_records(spark, sf_dir):
    return details.normalize_records(V.details(spark, sf_dir))


@query
def combined_texts(spark, sf_dir):
    text = combined_text(F.col("description"), F.col("collected_data"))
    return V.apps(spark, sf_dir).select("app_id", text.alias("combined_text"))


@query
def keyword_flags(spark, sf_dir):
    flagged = scoring.with_keyword_flags(V.apps(spark, sf_dir), groups=V.GROUPS)
    return flagged.select("app_id", "minority_candidate")


@query
def keyword_flags_conversations(spark, sf_dir):
    turns = V.table(spark, sf_dir, "conversations")
    flagged = scoring.with_keyword_flags(turns, "text", "role", V.GROUPS)
    return flagged.select("conv_id", "turn", "minority_candidate")


@query
def truncation_audit(spark, sf_dir):
    documents = V.table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = V.table(spark, sf_dir, "labels").select("doc_id", "quality")
    counted = truncation.with_token_count(documents, "text").join(labels, "doc_id", "left")
    return rounded(truncation.truncation_audit(counted, "quality", [128, 512]))


@query
def token_windows(spark, sf_dir):
    windows = truncation.token_windows(V.table(spark, sf_dir, "documents"), "text", 128)
    return windows.select(
        "doc_id",
        F.array_join("input_tokens", " ").alias("input_text"),
        F.size("input_tokens").alias("length"),
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("real_tokens"),
        F.array_join("attention_mask", "").alias("mask"),
    )


# Candidate search -----------------------------------------------------------------------------

def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates.search(
        V.table(spark, sf_dir, "documents"), "doc_id", F.col("text"), V.SEARCH
    )


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = V.table(spark, sf_dir, "documents").selectExpr("CAST(doc_id AS STRING) AS app_id", "text")
    return collect.find_candidates(texts, "app_id", F.col("text"), V.SEARCH)


@query
def keyword_matches(spark, sf_dir):
    return _hits(spark, sf_dir)


@query
def keyword_matches_many(spark, sf_dir):
    """About ten thousand keywords over all documents."""
    documents = V.table(spark, sf_dir, "documents")
    return keyword_join.search_many(documents, "doc_id", F.col("text"), V.keyword_runs(spark, sf_dir))


@query
def keyword_candidates(spark, sf_dir):
    return candidates.top_hits(_hits(spark, sf_dir))


def _turn_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits in turns, by conversation: ids that have many rows."""
    turns = V.table(spark, sf_dir, "conversations")
    return candidates.search(turns, "conv_id", F.col("text"), V.SEARCH)


@query
def keyword_candidates_repeated_ids(spark, sf_dir):
    return candidates.top_hits(_turn_hits(spark, sf_dir))


@query
def keyword_yield_repeated_ids(spark, sf_dir):
    return candidates.keyword_yield(_turn_hits(spark, sf_dir), keyword_table(spark, V.SEARCH))


@query
def collect_then_merge(spark, sf_dir):
    """Collected records, written as Parquet, with labels filled in, merged into the labelled ones."""
    collected = materialize(details.normalize_records(V.details(spark, sf_dir)), "collected")
    reviewed = collected.withColumns({
        "category_id": F.when(F.length("app_name") % 3 == 0, "EXC").otherwise(F.lit("2")),
        "function_type": F.when(F.length("app_name") % 2 == 0, "A"),
        "is_boundary_case": F.length("app_name") % 5 == 0,
    })
    return merge.merge_labeled(V.apps(spark, sf_dir), reviewed)


@query
def first_keyword(spark, sf_dir):
    return candidates.first_keyword(_hits(spark, sf_dir), V.SEARCH)


@query
def keyword_yield(spark, sf_dir):
    return candidates.keyword_yield(_hits(spark, sf_dir), keyword_table(spark, V.SEARCH))


@query
def discovered_candidates(spark, sf_dir):
    return _candidates(spark, sf_dir)


@query
def enrich_candidates(spark, sf_dir):
    records, _ = collect.collect_records(_candidates(spark, sf_dir), V.details(spark, sf_dir))
    return records


@query
def missing_details(spark, sf_dir):
    _, missing = collect.collect_records(_candidates(spark, sf_dir), V.details(spark, sf_dir))
    return missing


# Labels, split, weights -----------------------------------------------------------------------

def _with_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that a stratified split accepts: a category is required there."""
    return V.apps(spark, sf_dir).filter("category_id IS NOT NULL")


@query
def category_dictionary(spark, sf_dir):
    return encode.category_dictionary(V.apps(spark, sf_dir))


@query
def encode_labels(spark, sf_dir):
    return encode.encode_labels(V.apps(spark, sf_dir)).select(
        "app_id", "category_label", "function_label"
    )


@query
def encode_single_axis(spark, sf_dir):
    return encode.encode_single_axis(V.apps(spark, sf_dir)).select(
        "app_id", "category_id", "category_label"
    )


@query
def decode_labels(spark, sf_dir):
    number = F.expr("try_cast(category_id AS INT)")
    return V.apps(spark, sf_dir).select(
        "app_id",
        lookup_or_blank(number, CATEGORY_NAMES).alias("category_name"),
        lookup_or_blank(F.col("function_type"), FUNCTION_NAMES).alias("function_name"),
        lookup(F.col("function_type"), FUNCTION_INDEX).alias("function_label"),
    )


@query
def split_allocation(spark, sf_dir):
    counts = _with_category(spark, sf_dir).groupBy("category_id").agg(F.count("*").alias("n"))
    return split.allocate(counts, "category_id")


@query
def stratified_split(spark, sf_dir):
    records = _with_category(spark, sf_dir).select("app_id", "category_id")
    return split.stratified_split(records, "app_id", "category_id")


@query
def split_preconditions(spark, sf_dir):
    rows = V.table(spark, sf_dir, "documents").selectExpr(f"{V.SPLIT_TROUBLE} AS label")
    counts = rows.groupBy("label").agg(F.count("*").alias("n"))
    return split.split_preconditions(counts, "label", V.TROUBLE_TEST_SIZE)


@query
def class_weights(spark, sf_dir):
    records = _with_category(spark, sf_dir).select("app_id", "category_id", "function_type")
    train = split.stratified_split(records, "app_id", "category_id").filter("is_train")
    return rounded(encode.class_weights(encode.encode_labels(train), "category_label"))


# Diagnostics ----------------------------------------------------------------------------------

JUDGED_AXES = [("quality", "quality", "quality_pred"), ("toxic", "toxic", "toxic_pred")]


def _judged_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion(V.judged(spark, sf_dir), JUDGED_AXES)


@query
def confusion(spark, sf_dir):
    sliced = metrics.confusion(V.judged(spark, sf_dir), JUDGED_AXES, ["lang"])
    return metrics.over_all_slices(sliced, "lang")


@query
def class_report(spark, sf_dir):
    return rounded(metrics.class_report(_judged_counts(spark, sf_dir)))


@query
def report_summary(spark, sf_dir):
    return rounded(metrics.report_summary(metrics.class_report(_judged_counts(spark, sf_dir))))


@query
def macro_scores(spark, sf_dir):
    summary = metrics.report_summary(metrics.class_report(_judged_counts(spark, sf_dir)))
    return rounded(metrics.model_score(summary))


@query
def report_text(spark, sf_dir):
    report = metrics.class_report(_judged_counts(spark, sf_dir))
    return metrics.report_lines(report, {"toxic": {0: "clean", 1: "toxic"}})


REPORT_SECTIONS = [("quality", "=== quality ==="), ("toxic", "=== toxic: all rows ===")]
REPORT_NAMES = {"quality": {0: "of no particular use", 1: "good"}, "toxic": {0: "clean", 1: "toxic"}}


@query
def report_text_slices(spark, sf_dir):
    """A whole report: headings, columns as wide as their names, slices."""
    sliced = V.labelled_documents(spark, sf_dir).selectExpr(
        "CASE WHEN doc_id % 10 = 9 THEN 'EXC' ELSE 'real' END AS slice",
        *[f"{e} AS {n}" for n, e in V.JUDGED.items()])
    counts = materialize(metrics.confusion(sliced, JUDGED_AXES, ["slice"]), "confusion")
    total = counts.groupBy("axis", "truth", "predicted").agg(F.sum("n").alias("n"))
    slices = metrics.slice_macro_f1(counts.filter("axis = 'toxic'"), "slice")
    return metrics.whole_report(
        metrics.class_report(total), slices, REPORT_SECTIONS, "=== slices ===",
        [("real", "no sentinel"), ("EXC", "sentinel"), ("none", "no rows")], REPORT_NAMES)


@query
def slice_macro_f1(spark, sf_dir):
    rows = V.apps(spark, sf_dir).select(
        metrics.category_slice(F.col("category_id")).alias("slice"),
        F.expr(V.FUNCTION_TRUTH).alias("truth"), F.expr(V.FUNCTION_RULE).alias("pred"),
    )
    counts = metrics.confusion(rows, [("function", "truth", "pred")], ["slice"])
    return rounded(metrics.slice_macro_f1(metrics.over_all_slices(counts, "slice"), "slice"))


@query
def two_axis_log_loss(spark, sf_dir):
    logits = _with_logits(V.vectors(spark, sf_dir))
    return rounded(losses.two_axis_log_loss(logits, "category_logits", "function_logits"))


@query
def weighted_log_loss(spark, sf_dir):
    rows = V.vectors(spark, sf_dir)
    weights = encode.class_weights(rows, "category_label")
    return rounded(losses.weighted_log_loss(
        _with_logits(rows), "category_logits", "category_label", weights
    ))


# Models ---------------------------------------------------------------------------------------

VECTOR_AXES = [
    ("category", "category_label", "category_pred"),
    ("function", "function_label", "function_pred"),
]


def _split_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.stratified_split(V.vectors(spark, sf_dir), "vec_id", "category_id")


@query
def evaluate_holdout(spark, sf_dir):
    held_out = _split_vectors(spark, sf_dir).filter("NOT is_train")
    predicted = scoring.with_predictions(_with_logits(held_out))
    return rounded(metrics.class_report(metrics.confusion(predicted, VECTOR_AXES)))


def _balance(parts: DataFrame, axis: str, weighted: bool = False) -> DataFrame:
    """Per class: rows fitted, the fitted probability of the class summed over them, rows held out.

    A free intercept makes that sum equal the (weighted) number of rows of the class at the optimum.
    """
    label = F.col(f"{axis}_label")
    known = parts.filter(label.isNotNull())
    if weighted:
        weights = encode.class_weights(known.filter("is_train"), f"{axis}_label")
        known = encode.with_class_weight(known, weights, f"{axis}_label")
    else:
        known = known.withColumn("weight", F.lit(1.0))
    shares = known.select("is_train", "weight", label.alias("label"),
                          F.posexplode(softmax(F.col(f"{axis}_logits"))).alias("class", "p"))
    own = F.col("label") == F.col("class")
    return shares.groupBy("class").agg(
        F.count_if(F.col("is_train") & own).alias("train_rows"),
        F.round(F.sum(F.when(F.col("is_train"), F.col("p") * F.col("weight"))), 3).alias("predicted_rows"),
        F.count_if(~F.col("is_train") & own).alias("test_rows"),
    ).select(F.lit(axis).alias("axis"), "*")


def _labelled_texts(spark: SparkSession, sf_dir: str, *labels: str) -> DataFrame:
    rows = V.labelled_documents(spark, sf_dir).selectExpr("doc_id", "text AS combined_text", *labels)
    return materialize(split.stratified_split(rows, "doc_id", "category_label"), "prepared")


def two_heads_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _labelled_texts(spark, sf_dir, "quality AS category_label", "toxic AS function_label")
    return heads.score_heads(heads.train_two_heads(parts.filter("is_train")), parts)


@query
def train_two_heads(spark, sf_dir):
    scored = materialize(two_heads_scored(spark, sf_dir).drop("combined_text"), "scored")
    return _balance(scored, "category").union(_balance(scored, "function"))


@query
def train_weighted_text_head(spark, sf_dir):
    """The rare class of the second axis as the only one, with balanced weights."""
    parts = _labelled_texts(spark, sf_dir, "toxic AS category_label")
    model = heads.train_weighted_text_head(parts.filter("is_train"))
    return _balance(heads.score_heads(model, parts, axes=["category"]), "category", weighted=True)


@query
def model_settings(spark, sf_dir):
    """Settings of a saved model, read back."""
    rows = V.labelled_documents(spark, sf_dir).selectExpr("doc_id", "text AS combined_text", "toxic AS category_label")
    parts = materialize(split.stratified_split(rows, "doc_id", "category_label"), "prepared")
    model = heads.train_weighted_text_head(parts.filter("is_train"), num_features=1 << 10, max_iter=3)
    path = scratch_path(spark, "model")
    settings = models_out.model_settings(
        parts, "doc_id", 0.2, 42, "category_label", num_features=1 << 10, max_iter=3)
    models_out.save_model(model, models_out.label_config(spark, [0, 1], {}), path, settings)
    found = models_in.read_settings(spark, path)
    return spark.createDataFrame(sorted(found.items()), "name string, value string")


@query
def train_weighted_head(spark, sf_dir):
    parts = materialize(_split_vectors(spark, sf_dir), "prepared")
    model = heads.train_weighted_head(parts.filter("is_train"), "embedding", "category_label")
    return _balance(heads.score_weighted_head(model, parts, "embedding"), "category", weighted=True)


# Run logs -------------------------------------------------------------------------------------

def _epoch_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epochs of one run per language, scored over all labelled documents."""
    rows = V.labelled_documents(spark, sf_dir).selectExpr(
        "lang AS run", "doc_id", "n_chars", "quality", "toxic",
        f"explode(sequence(1, {V.EPOCHS})) AS epoch",
    )
    rows = rows.selectExpr(
        "run", "epoch", "quality", "toxic",
        f"{V.EPOCH_QUALITY} AS quality_pred", f"{V.EPOCH_TOXIC} AS toxic_pred",
    )
    by = ["run", "epoch"]
    counts = metrics.confusion(rows, JUDGED_AXES, by)
    summary = metrics.report_summary(metrics.class_report(counts, by), by)
    one = lambda axis, c: F.max(F.when(F.col("axis") == axis, F.col(c)))
    wide = summary.groupBy(*by).agg(
        one("quality", "accuracy").alias("acc1"), one("quality", "macro_f1").alias("f1_1"),
        one("toxic", "accuracy").alias("acc2"), one("toxic", "macro_f1").alias("f1_2"),
    )
    return wide.withColumns({
        "max_epochs": F.lit(V.EPOCHS),
        "loss": 2 - F.col("acc1") - F.col("acc2"),
        "avg_f1": (F.col("f1_1") + F.col("f1_2")) / 2,
    })


def _logged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same epochs after a trip through log text."""
    return parse_epochs(format_epochs(_epoch_scores(spark, sf_dir)))


@query
def epoch_log(spark, sf_dir):
    return _logged(spark, sf_dir)


@query
def early_stopping(spark, sf_dir):
    return runlog.early_stopping(_logged(spark, sf_dir)).select(
        "run", "epoch", "avg_f1", "is_best", "streak", "stops"
    )


def _restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs in which every run is started again after some epochs."""
    epochs = materialize(_epoch_scores(spark, sf_dir), "epochs")
    first = format_epochs(epochs.filter(F.col("epoch") <= V.RESTART)).withColumnRenamed("text", "first")
    return format_epochs(epochs).join(first, "run").select("run", F.concat_ws("\n", "first", "text").alias("text"))


@query
def early_stopping_restarts(spark, sf_dir):
    return runlog.early_stopping(parse_segments(_restarted(spark, sf_dir))).select(
        "run", "segment", "epoch", "avg_f1", "is_best", "streak", "stops"
    )


@query
def one_axis_checkpoints(spark, sf_dir):
    """Best checkpoints of single-axis logs, next to two-axis ones of the same runs."""
    epochs = materialize(_epoch_scores(spark, sf_dir), "epochs")
    single = epochs.withColumns({"acc": F.col("acc1"), "macro_f1": F.col("f1_1")})
    logs = format_epochs(epochs).unionByName(format_one_axis_epochs(single))
    return runlog.best_checkpoints(parse_any(logs), score="score")


@query
def best_checkpoint(spark, sf_dir):
    return runlog.best_checkpoints(_logged(spark, sf_dir))


@query
def select_run(spark, sf_dir):
    return runlog.select_run(runlog.best_checkpoints(_logged(spark, sf_dir)))
