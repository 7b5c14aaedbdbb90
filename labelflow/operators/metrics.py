"""Classification diagnostics out of one confusion table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelflow.functions.text import fixed, is_sentinel

SENTINEL_SLICE, REAL_SLICE, ALL = "EXC", "real", "all"


def category_slice(category: Column) -> Column:
    """`EXC` for sentinel rows, `real` for all others; a missing category counts as real."""
    return F.when(is_sentinel(category), SENTINEL_SLICE).otherwise(REAL_SLICE)


def confusion(
    df: DataFrame, axes: Sequence[tuple[str, str, str]], by: Sequence[str] = ()
) -> DataFrame:
    """`(axis, *by, truth, predicted, n)` for axes given as `(name, truth, predicted)` columns.

    A null truth is ignored on its axis only. This is the only pass over the rows: every metric
    below works on its few counts, and equal rows are counted before the shuffle.
    """
    per_axis = F.inline(F.array(*[
        F.struct(
            F.lit(name).alias("axis"),
            F.col(truth).cast("int").alias("truth"),
            F.col(predicted).cast("int").alias("predicted"),
        )
        for name, truth, predicted in axes
    ]))
    rows = df.select(*by, per_axis).filter(F.col("truth").isNotNull())
    return rows.groupBy("axis", *by, "truth", "predicted").agg(F.count("*").alias("n"))


def over_all_slices(counts: DataFrame, slice_col: str) -> DataFrame:
    """Add the slice `all` to a sliced confusion table, by adding up its counts."""
    both = F.explode(F.array(F.col(slice_col), F.lit(ALL))).alias(slice_col)
    return (
        counts.select("axis", both, "truth", "predicted", "n")
        .groupBy("axis", slice_col, "truth", "predicted")
        .agg(F.sum("n").alias("n"))
    )


def _ratio(part: Column, whole: Column) -> Column:
    """Zero when the denominator is zero."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def class_report(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support of every class that is true or predicted somewhere."""
    keys = ["axis", *by]
    hit = F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)
    sides = counts.select(*keys, F.inline(F.array(
        F.struct(F.col("truth").alias("class"), F.col("n").alias("support"),
                 F.lit(0).cast("bigint").alias("predicted_rows"), hit.cast("bigint").alias("hits")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("bigint").alias("support"),
                 F.col("n").alias("predicted_rows"), F.lit(0).cast("bigint").alias("hits")),
    )))
    # A row without a prediction is a miss for its true class and predicts none.
    per_class = sides.filter(F.col("class").isNotNull()).groupBy(*keys, "class").agg(
        F.sum("support").alias("support"),
        F.sum("predicted_rows").alias("predicted_rows"),
        F.sum("hits").alias("hits"),
    )
    hits, support, predicted = F.col("hits"), F.col("support"), F.col("predicted_rows")
    return per_class.select(
        *keys, "class",
        _ratio(hits, predicted).alias("precision"),
        _ratio(hits, support).alias("recall"),
        _ratio(2 * hits, support + predicted).alias("f1"),
        "support", "predicted_rows", "hits",
    )


def report_summary(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, macro and support-weighted averages of a class report."""
    keys = ["axis", *by]
    return report.groupBy(*keys).agg(*_summary_columns())


def _summary_columns() -> list[Column]:
    support = F.sum("support")
    weighted = lambda c: F.sum(F.col(c) * F.col("support")) / support
    return [
        (F.sum("hits").cast("double") / support.cast("double")).alias("accuracy"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
        weighted("precision").alias("weighted_precision"),
        weighted("recall").alias("weighted_recall"),
        weighted("f1").alias("weighted_f1"),
        support.alias("support"),
    ]


def model_score(summary: DataFrame) -> DataFrame:
    """One row: the mean of the axes' macro F1, by which checkpoints are compared."""
    return summary.agg(F.avg("macro_f1").alias("avg_macro_f1"))


def slice_macro_f1(counts: DataFrame, slice_col: str) -> DataFrame:
    """Macro F1 per slice over the classes true in that slice; other predictions are misses.

    A slice without rows gives no row.
    """
    report = class_report(counts, [slice_col]).filter(F.col("support") > 0)
    return report.groupBy("axis", slice_col).agg(
        F.sum("support").alias("n"), F.avg("f1").alias("macro_f1")
    )


def report_lines(report: DataFrame, names: dict[str, dict[int, str]] | None = None) -> DataFrame:
    """Text lines `(axis, line_no, line)` of the report, two decimals, with its summary rows.

    `names` gives display names per axis and class. The report has one row per class, so the
    lines of an axis are put together in one row before they are numbered.
    """
    label = F.col("class").cast("string")
    for axis, table in (names or {}).items():
        for value, name in table.items():
            label = F.when((F.col("axis") == axis) & (F.col("class") == value), name).otherwise(label)

    def line(name: Column, *cells: Column) -> Column:
        return F.format_string("%14s" + " %9s" * len(cells), name, *cells)

    two = lambda *columns: [fixed(F.col(c), 2) for c in columns]
    count, blank = F.col("support").cast("string"), F.lit("")
    body = report.withColumn("line", line(label, *two("precision", "recall", "f1"), count))
    rows = F.array_sort(F.collect_list(F.struct("class", "line"))).alias("rows")
    whole = body.groupBy("axis").agg(rows, *_summary_columns()).select("axis", F.concat(
        F.array(line(blank, *map(F.lit, ["precision", "recall", "f1-score", "support"]))),
        F.transform("rows", lambda r: r["line"]),
        F.array(
            line(F.lit("accuracy"), blank, blank, *two("accuracy"), count),
            line(F.lit("macro avg"), *two("macro_precision", "macro_recall", "macro_f1"), count),
            line(F.lit("weighted avg"),
                 *two("weighted_precision", "weighted_recall", "weighted_f1"), count),
        ),
    ).alias("lines"))
    return whole.select("axis", F.posexplode("lines").alias("line_no", "line"))


def whole_report(
    report: DataFrame, slices: DataFrame, sections: Sequence[tuple[str, str]],
    slice_heading: str, slice_names: Sequence[tuple[str, str]],
    names: dict[str, dict[int, str]] | None = None, slice_col: str = "slice",
) -> DataFrame:
    """Text lines `(line_no, line)` of a whole report: a section per axis, then its slices.

    `sections` gives axes with their headings, `names` display names per axis and class,
    `slice_names` slices with their display names, in order; slices without rows have no line. Every
    line is a row of one table of a few rows per class, and the width of the name column is a window
    over the names of its section.
    """
    axis_no = F.lit(None).cast("int")
    for i, (axis, _) in reversed(list(enumerate(sections))):
        axis_no = F.when(F.col("axis") == axis, F.lit(i)).otherwise(axis_no)
    label = F.col("class").cast("string")
    for axis, table in (names or {}).items():
        for value, name in table.items():
            label = F.when((F.col("axis") == axis) & (F.col("class") == value), F.lit(name)).otherwise(label)

    def row(part: int, name: Column, *cells: Column, place: Column = F.lit(0)) -> Column:
        return F.struct(
            F.lit(part).alias("part"), place.cast("int").alias("place"), name.alias("name"),
            F.array(*cells).cast("array<string>").alias("cells"))

    two = lambda *columns: [fixed(F.col(c), 2) for c in columns]
    count, blank = F.col("support").cast("string"), F.lit("")
    heads = [F.lit(h) for h in ("precision", "recall", "f1-score", "support")]
    classes = report.select("axis", row(3, label, *two("precision", "recall", "f1"), count, place=F.col("class")).alias("r"))
    whole = report.groupBy("axis").agg(*_summary_columns())
    frame = whole.select("axis", F.explode(F.array(
        row(1, blank, *heads), row(2, blank), row(4, blank),
        row(5, F.lit("accuracy"), blank, blank, *two("accuracy"), count),
        row(6, F.lit("macro avg"), *two("macro_precision", "macro_recall", "macro_f1"), count),
        row(7, F.lit("weighted avg"), *two("weighted_precision", "weighted_recall", "weighted_f1"), count),
        row(8, blank),
    )).alias("r"))
    table = classes.unionAll(frame).select(axis_no.alias("section"), "r.*").filter("section IS NOT NULL")
    width = F.max(F.char_length("name")).over(W.partitionBy("section"))
    cells = F.array_join(F.transform("cells", lambda c: F.concat(F.lit(" "), F.lpad(c, 9, " "))), "")
    body = table.withColumn("width", width).select("section", "part", "place", F.when(
        F.size("cells") > 0, F.concat(F.lpad("name", F.col("width"), F.lit(" ")), F.lit(" "), cells)
    ).otherwise("").alias("line"))

    spark = report.sparkSession
    headings = [(i, 0, 0, h) for i, (_, h) in enumerate(sections)] + [(len(sections), 0, 0, slice_heading)]
    places = spark.createDataFrame([(s, i, n) for i, (s, n) in enumerate(slice_names)], f"{slice_col} string, place int, name string")
    sliced = slices.join(F.broadcast(places), slice_col).select(
        F.lit(len(sections)).alias("section"), F.lit(1).alias("part"), "place",
        F.format_string("[%s] n=%s, macro F1=%s", "name", F.col("n").cast("string"), fixed(F.col("macro_f1"), 4)).alias("line"))
    lines = spark.createDataFrame(headings, body.schema).unionAll(body).unionAll(sliced)
    number = F.row_number().over(W.orderBy("section", "part", "place")) - 1
    return lines.select(number.alias("line_no"), "line")
