"""Candidate search: ordered keywords over a text table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelflow.functions.codes import at_index
from labelflow.scale import dimension
from labelflow.schema import DEFAULT_HITS_PER_KEYWORD

# Local winners per keyword are merged in this many groups before the last ranking.
_MERGE_GROUPS = 64


def occurrences(text: Column, needle: Column) -> Column:
    """How often `needle` stands in `text`, without overlaps."""
    # Byte lengths are known without reading the text; a quotient of them is a whole number.
    rest = F.octet_length(F.replace(text, needle, F.lit("")))
    return ((F.octet_length(text) - rest) / F.octet_length(needle)).cast("bigint")


def search(
    texts: DataFrame, id_col: str, text: Column, keywords: Sequence[str]
) -> DataFrame:
    """Every match `(pos, keyword, id, score)`; score counts the occurrences in the whole text.

    Both sides are lower-cased. The keywords are literals, so this is one pass without a join,
    and only ids and counts leave it, never the text.
    """
    if any(not k.strip() for k in keywords):
        raise ValueError("blank keyword")
    table = F.array(*[
        F.struct(F.lit(i).alias("pos"), F.lit(k).alias("keyword"), F.lower(F.lit(k)).alias("needle"))
        for i, k in enumerate(keywords)
    ])
    low = F.col("low")
    found = F.transform(
        F.filter(table, lambda k: F.contains(low, k["needle"])),
        lambda k: F.struct(k["pos"].alias("pos"), k["keyword"].alias("keyword"),
                           occurrences(low, k["needle"]).alias("score")),
    )
    return (
        texts.select(F.col(id_col).alias("id"), F.lower(text).alias("low"))
        .select("id", F.inline(found))
        .select("pos", "keyword", "id", "score")
    )


def per_id(hits: DataFrame) -> DataFrame:
    """One row for each keyword and id; the scores of an id that has several rows are added."""
    return hits.groupBy("pos", "keyword", "id").agg(F.sum("score").alias("score"))


def top_hits(hits: DataFrame, n: int = DEFAULT_HITS_PER_KEYWORD) -> DataFrame:
    """The `n` best ids of each keyword with their rank from 1; ties go to the smaller id.

    Each task keeps its own best `n` first, then groups of tasks do, so a keyword that matches
    most of the table never gathers its matches in one place.
    """
    best = [F.desc("score"), F.asc("id")]
    local = W.partitionBy("pos", "part").orderBy(*best)
    partial = (
        per_id(hits).withColumn("part", F.spark_partition_id() % _MERGE_GROUPS)
        .withColumn("r", F.row_number().over(local))
        .filter(F.col("r") <= n)
        .drop("r", "part")
    )
    final = W.partitionBy("pos").orderBy(*best)
    return partial.withColumn("hit_rank", F.row_number().over(final)).filter(F.col("hit_rank") <= n)


def first_keyword(hits: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """`(id, pos, keyword)`: the first keyword, in list order, that found each id.

    A hash aggregate without a sort; ids with many matches shrink before the shuffle.
    """
    first = hits.groupBy("id").agg(F.min("pos").alias("pos"))
    return first.withColumn("keyword", at_index(list(keywords), F.col("pos")))


def discovery_order(hits: DataFrame) -> DataFrame:
    """Distinct ids of ranked hits with the keyword position and rank that found them first."""
    first = hits.groupBy("id").agg(F.min(F.struct("pos", "hit_rank", "keyword")).alias("first"))
    return first.select("id", "first.pos", "first.hit_rank", "first.keyword")


def keyword_yield(hits: DataFrame, keywords: DataFrame) -> DataFrame:
    """Per keyword: ids it finds, ids it was first to find, and distinct ids so far, in list order.

    One aggregate by id holds the positions that found it, a set of at most one entry a keyword. The
    last steps run over the keyword list, one row per keyword.
    """
    found = hits.groupBy("id").agg(F.collect_set("pos").alias("found_by"))
    counts = (
        found.select(F.explode("found_by").alias("pos"), F.array_min("found_by").alias("first"))
        .groupBy("pos")
        .agg(F.count("*").alias("hits"), F.count_if(F.col("pos") == F.col("first")).alias("new_ids"))
    )
    listed = keywords.join(dimension(counts), "pos", "left").fillna(0, ["hits", "new_ids"])
    running = F.sum("new_ids").over(W.orderBy("pos").rowsBetween(W.unboundedPreceding, 0))
    return listed.select("pos", "keyword", "hits", "new_ids", running.alias("ids_so_far"))
