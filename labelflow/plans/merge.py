"""Merge reviewed records into the labelled table and describe the result."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Row

from labelflow.operators.merge import class_distribution, merge_labeled
from labelflow.operators.side import counts_of_merge, merge_side
from labelflow.sinks.records import write_records, write_records_csv


class Merged(NamedTuple):
    counts: Row
    distribution: DataFrame


def merge(
    existing: DataFrame, new: DataFrame, output: str, strict: bool = False, as_csv: bool = False
) -> Merged:
    """Write the merged table; counts and distribution come from a side table of the labels.

    Both inputs are read twice: for the side table and to be written. The counts are not observed
    during the write: once a session has used an `Observation`, later Spark ML transforms in it
    fail to serialize (Spark 4.1).
    """
    side = merge_side(existing, new, strict)
    merged = merge_labeled(existing, new, strict)
    if as_csv:
        write_records_csv(merged, output, byte_order_mark=True)
    else:
        write_records(merged, output)
    return Merged(counts_of_merge(side).first(), class_distribution(side.filter("NOT dropped")))
