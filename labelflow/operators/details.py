"""Detail records of candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelflow.functions.text import blank_if_null
from labelflow.scale import dimension
from labelflow.schema import CANONICAL_COLUMNS, RECORD_SCHEMA, STORE_URL_TEMPLATE

# Columns a reviewer fills in later.
_BLANK = ["idea_desc", "collected_data", "category_id", "function_type", "is_boundary_case", "note"]


def normalize_records(details: DataFrame, lang: str = "ko", country: str = "kr") -> DataFrame:
    """Records from details `(app_id, title, description, genre, url)`.

    Null becomes blank, an absent or blank URL is built from the template. Label columns are null in
    their own type; a CSV file shows them as blank.
    """
    built = F.format_string(
        STORE_URL_TEMPLATE, F.col("app_id"), F.lit(lang), F.upper(F.lit(country))
    )
    url = blank_if_null(F.col("url"))
    columns = {
        "platform": F.lit("android"),
        "country": F.lit(country),
        "app_id": F.col("app_id"),
        "app_name": blank_if_null(F.col("title")),
        "description": blank_if_null(F.col("description")),
        "genre": blank_if_null(F.col("genre")),
        "store_url": F.when(url != "", url).otherwise(built),
        **{name: F.lit(None).cast(RECORD_SCHEMA[name].dataType) for name in _BLANK},
    }
    return details.select([columns[name].alias(name) for name in CANONICAL_COLUMNS])


def found_details(candidates: DataFrame, details: DataFrame) -> DataFrame:
    """Details of the candidates, one row each; `candidates` has distinct `app_id`s, unknown ones are skipped.

    Pass written candidates (`materialize`): their number is checked before the join, and few
    of them spare the detail table its shuffle.
    """
    found = details.join(dimension(candidates.select("app_id")), "app_id", "left_semi")
    rest = [c for c in details.columns if c != "app_id"]
    if not rest:
        return found.distinct()
    # Repeated details: the smallest by column order, the same one in every run.
    first = found.groupBy("app_id").agg(F.min(F.struct(*rest)).alias("first"))
    return first.select("app_id", "first.*").select(*details.columns)


def missing_details(candidates: DataFrame, details: DataFrame) -> DataFrame:
    """Candidates without a detail record."""
    known = found_details(candidates, details.select("app_id"))
    return candidates.join(known, "app_id", "left_anti")
