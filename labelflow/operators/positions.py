"""A global order of wide rows that sorts narrow ones only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelflow.operators.review import queue_order
from labelflow.scale import dimension, materialize

# Rows of one written range.
RANGE_ROWS = 100_000


def numbered(rows: DataFrame, row: str = "_row") -> DataFrame:
    """Rows with a number that stays: the table is written, so it holds after lost tasks too."""
    return materialize(rows.withColumn(row, F.monotonically_increasing_id()), "numbered")


def positions(narrow: DataFrame, order: list[Column], row: str = "_row") -> DataFrame:
    """`(row, position)`: places from 1 in the order; ties of `order` are broken by `row`.

    The narrow rows are dealt to ranges and sorted there. Each range is written, its rows are
    numbered from its start, and the sizes of the ranges before it (a row a range) give the rest.
    """
    ranges = max(1, int(narrow.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keys = [*order, F.asc(row)]
    placed = narrow.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).select(
        row, F.monotonically_increasing_id().alias("at"))
    written = materialize(placed, "ranges").select(
        row, F.shiftright("at", 33).alias("range"), F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("place"))
    sizes = written.groupBy("range").agg(F.count("*").alias("rows"))
    before = sizes.selectExpr("range", "sum(rows) OVER (ORDER BY range) - rows AS before")
    return written.join(dimension(before, name="range-starts"), "range").select(
        row, (F.col("before") + F.col("place") + 1).alias("position"))


def with_positions(
    rows: DataFrame, key: str = "app_id", minority_first: bool = False, row: str = "_row"
) -> DataFrame:
    """`numbered` rows with `position` in the place of `row`, from 1 for the row to review first.

    Only confidence, flag, key and number are sorted; the wide rows meet their positions in a hash join.
    """
    narrow = rows.select(row, "min_confidence", key, *(["minority_candidate"] if minority_first else []))
    places = positions(narrow, queue_order(key, minority_first), row)
    return rows.join(places.hint("shuffle_hash"), row).drop(row)


def review_positions(scored: DataFrame, key: str = "app_id", minority_first: bool = False) -> DataFrame:
    """All columns of `scored` and its global `position` in the review queue."""
    row = "_row"
    while row in scored.columns:
        row += "_"
    return with_positions(numbered(scored, row), key, minority_first, row)


def in_ranges(positioned: DataFrame, total: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """`total` rows dealt to partitions by range of `position`, in order, ready to be written.

    Positions are dense, so a row's range follows from its position: nothing is sampled. Each range
    is put in order by its own task, a bounded number of rows; the files follow each other.
    """
    ranges = max(1, -(-total // range_rows))
    range_of = F.floor((F.col("position") - 1) / range_rows).cast("int")
    return positioned.repartitionById(ranges, range_of).sortWithinPartitions("position")
