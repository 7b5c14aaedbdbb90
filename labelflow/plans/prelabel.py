"""Pre-label records for review."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelflow.functions.text import combined_text
from labelflow.operators.positions import RANGE_ROWS, in_ranges, numbered, with_positions
from labelflow.operators.review import confidence_summary, review_top
from labelflow.operators.scoring import with_keyword_flags, with_predictions
from labelflow.schema import AUDIT_COLUMNS


class Prelabelled(NamedTuple):
    queue: DataFrame
    summary: DataFrame


def with_combined_text(records: DataFrame) -> DataFrame:
    return records.withColumn(
        "combined_text", combined_text(F.col("description"), F.col("collected_data"))
    )


def prelabel(
    records: DataFrame, score: Callable[[DataFrame], DataFrame],
    carry: Sequence[str] | None = None, top: int | None = None, minority_first: bool = False,
    key: str = "app_id", **labels,
) -> Prelabelled:
    """Review queue and its summary.

    `carry` names the record columns of the queue, all by default. `top` keeps the first rows only;
    `minority_first` puts flagged rows in front. The summary covers all rows.

    `score` adds `category_logits` and `function_logits` to records with `combined_text`; `labels`
    go to `with_predictions`. The scored table is written once, so the model runs once per row
    although queue and summary read it again. The queue is ordered by positions of narrow rows, and
    its partitions are ranges of positions: written files follow each other in review order.
    """
    scored = with_predictions(score(with_combined_text(records)), **labels)
    own = [c for c in carry or records.columns if c not in AUDIT_COLUMNS]
    needed = own if key in own else [*own, key]
    rows = numbered(with_keyword_flags(scored).select(*needed, *AUDIT_COLUMNS))
    if top is not None:
        queue = review_top(rows, top, key, minority_first)
    else:
        queue = in_ranges(with_positions(rows, key, minority_first), rows.count(), RANGE_ROWS)
    return Prelabelled(queue.select(*own, *AUDIT_COLUMNS), confidence_summary(rows))
