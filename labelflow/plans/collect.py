"""Collect records: keyword search over a text table, then details of what was found."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelflow.operators.candidates import discovery_order, search, top_hits
from labelflow.operators.keyword_join import search_many
from labelflow.operators.details import found_details, missing_details, normalize_records
from labelflow.scale import few_rows, materialize
from labelflow.schema import DEFAULT_HITS_PER_KEYWORD, SEARCH_KEYWORDS

# Up to this many keywords are literals of one search expression; longer lists are joined.
LITERAL_KEYWORDS = 200


def search_any(texts: DataFrame, id_col: str, text: Column, keywords: DataFrame) -> DataFrame:
    """Matches of a table `(pos, keyword)` of any length; the rows don't depend on the way taken."""
    few = few_rows(keywords.select("pos", "keyword"), LITERAL_KEYWORDS)
    if few is None:
        return search_many(texts, id_col, text, keywords)
    listed = sorted(few)
    hits = search(texts, id_col, text, [r.keyword for r in listed])
    # Positions of the table may have gaps.
    return hits.withColumn("pos", F.get(F.lit([r.pos for r in listed]), F.col("pos"))) if listed else hits


def find_candidates(
    texts: DataFrame, id_col: str, text: Column,
    keywords: Sequence[str] | DataFrame = SEARCH_KEYWORDS, n_hits: int = DEFAULT_HITS_PER_KEYWORD,
) -> DataFrame:
    """Distinct ids `(app_id, pos, hit_rank, keyword)`, written once; `keywords` is a list or a table."""
    if isinstance(keywords, DataFrame):
        matches = search_any(texts, id_col, text, keywords)
    else:
        matches = search(texts, id_col, text, keywords)
    hits = top_hits(matches, n_hits)
    found = discovery_order(hits).withColumnRenamed("id", "app_id")
    return materialize(found, "candidates")


def collect_records(
    candidates: DataFrame, details: DataFrame, lang: str = "ko", country: str = "kr"
) -> tuple[DataFrame, DataFrame]:
    """Normalized records of the candidates, and the candidates that have no details."""
    records = normalize_records(found_details(candidates, details), lang, country)
    return records, missing_details(candidates, details)


def in_discovery_order(records: DataFrame, candidates: DataFrame) -> DataFrame:
    """Records in the order in which the search found them."""
    return (
        records.join(candidates.select("app_id", "pos", "hit_rank"), "app_id")
        .orderBy("pos", "hit_rank", F.col("app_id"))
        .select(*records.columns)
    )
