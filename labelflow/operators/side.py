"""A narrow side table of labels, written once, from which everything but the texts follows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelflow.functions.text import has_text
from labelflow.operators.merge import excluded
from labelflow.scale import materialize

EXISTING, NEW = "existing", "new"


def _labels(records: DataFrame, *keys: str) -> DataFrame:
    """Label columns and keys; a note is reduced to whether there is one."""
    note = F.when(has_text(F.col("note")), F.lit("noted")).alias("note")
    return records.select(*keys, "category_id", "function_type", "is_boundary_case", note)


def label_side(records: DataFrame, key: str) -> DataFrame:
    """One read of `records`: contract, dictionary, distribution, weights and split cuts come from this."""
    return materialize(_labels(records, key), "side")


def merge_side(existing: DataFrame, new: DataFrame, strict: bool = False) -> DataFrame:
    """One read of both sides of a merge: labels with their `source`, and whether the row is `dropped`."""
    old = _labels(existing).withColumns({"source": F.lit(EXISTING), "dropped": F.lit(False)})
    fresh = _labels(new).withColumns({"source": F.lit(NEW), "dropped": excluded(strict)})
    return materialize(old.unionByName(fresh), "side")


def counts_of_merge(side: DataFrame) -> DataFrame:
    """One row: existing, new, dropped and merged rows."""
    is_new, dropped = F.col("source") == NEW, F.col("dropped")
    return side.agg(
        F.count_if(~is_new).alias("existing_rows"),
        F.count_if(is_new & ~dropped).alias("new_rows"),
        F.count_if(dropped).alias("dropped_rows"),
        F.count_if(~dropped).alias("merged_rows"),
    )
