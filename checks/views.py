"""Views that turn the given tables into records, details, truth and predictions.

The expressions are plain SQL that Spark and DuckDB read alike, so both sides of a check start
from the same rows. Derived values (which row is a sentinel, which name is missing) follow from
the ids; no row of a table is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Labelled records: null, blank and sentinel labels, missing names and texts, two rare classes.
APPS = {
    "platform": "CASE WHEN doc_id % 2 = 0 THEN 'android' ELSE 'ios' END",
    "country": "'kr'",
    "app_id": "CAST(doc_id AS STRING)",
    "app_name": "CASE WHEN doc_id % 29 = 28 THEN NULL ELSE concat(lang, ' ', source) END",
    "description": "CASE WHEN doc_id % 37 = 36 THEN NULL ELSE text END",
    "genre": "source",
    "store_url": "concat('https://example.org/', source, '/', CAST(doc_id AS STRING))",
    "idea_desc": "CASE WHEN doc_id % 17 = 5 THEN 'n/a' WHEN doc_id % 17 = 6 THEN '' ELSE lang END",
    "collected_data":
        "CASE WHEN doc_id % 3 = 0 THEN NULL ELSE concat('n_chars=', CAST(n_chars AS STRING)) END",
    "category_id":
        "CASE WHEN doc_id % 10 = 9 THEN 'EXC' WHEN doc_id % 41 = 40 THEN NULL "
        "WHEN doc_id % 100 = 6 THEN '6' WHEN doc_id % 100 = 7 THEN '7' "
        "ELSE CAST(doc_id % 6 AS STRING) END",
    "function_type":
        "CASE WHEN doc_id % 20 = 9 THEN NULL WHEN doc_id % 50 = 19 THEN '  ' "
        "WHEN doc_id % 43 = 42 THEN NULL "
        "ELSE substr('ABCD', CAST(1 + doc_id % 4 AS INT), 1) END",
    "is_boundary_case": "doc_id % 11 = 3",
    "note":
        "CASE WHEN doc_id % 22 = 3 THEN NULL "
        "WHEN doc_id % 11 = 3 THEN concat('between, \"', lang, '\" and more') ELSE NULL END",
}

# Cells that their columns cannot hold, as text for a CSV file.
BAD_CELLS = {
    "category_id": "CASE WHEN doc_id % 19 = 3 THEN 'six' WHEN doc_id % 10 = 9 THEN 'EXC' "
                   "WHEN doc_id % 31 = 4 THEN '2.5' ELSE CAST(doc_id % 6 AS STRING) END",
    "function_type": "CASE WHEN doc_id % 23 = 1 THEN 'E' WHEN doc_id % 23 = 2 THEN 'NA' ELSE 'A' END",
    "is_boundary_case": "CASE WHEN doc_id % 13 = 0 THEN 'maybe' WHEN doc_id % 13 = 1 THEN 'n/a' ELSE 'true' END",
    "min_confidence": "CASE WHEN doc_id % 17 = 0 THEN 'high, \"very\"' ELSE '0.5' END",
    "text": "text",
}
# A label that a stratified split cannot take.
SPLIT_TROUBLE = (
    "CASE WHEN doc_id % 41 = 40 THEN NULL WHEN doc_id = 7 THEN 'solo' ELSE CAST(doc_id % 6 AS STRING) END"
)
TROUBLE_TEST_SIZE = 0.001

# Detail records: absent and blank URLs, absent titles and descriptions.
DETAILS = {
    "app_id": "CAST(page_id AS STRING)",
    "title":
        "CASE WHEN page_id % 9 = 4 THEN NULL "
        "ELSE regexp_extract(html, '<title>(.*?)</title>', 1) END",
    "description": "CASE WHEN page_id % 7 = 3 THEN NULL ELSE html END",
    "genre": "CASE WHEN page_id % 8 = 1 THEN NULL ELSE regexp_extract(html, 'lang=\"([a-z]+)\"', 1) END",
    "url": "CASE WHEN page_id % 10 = 0 THEN NULL WHEN page_id % 10 = 5 THEN '' ELSE url END",
}

# Truth of two axes and a rule as prediction.
JUDGED = {
    "doc_id": "doc_id",
    "lang": "lang",
    "quality": "quality",
    "toxic": "toxic",
    "quality_pred": "CAST(n_chars >= 200 AS INT)",
    "toxic_pred": "CAST(doc_id % 7 = 0 AS INT)",
}

# Labels of the vectors: 8 and 9 play the sentinel on axis 1, axis 2 has four codes.
VECTOR_LABELS = {
    "category_id": "CASE WHEN label < 8 THEN CAST(label AS STRING) ELSE 'EXC' END",
    "category_label": "CASE WHEN label < 8 THEN label ELSE NULL END",
    "function_label": "label % 4",
}

# Function code predicted by a rule that is wrong for every fifth record.
FUNCTION_RULE = (
    "CAST((CAST(app_id AS BIGINT) + CASE WHEN CAST(app_id AS BIGINT) % 5 = 0 THEN 1 ELSE 0 END) % 4"
    " AS INT)"
)
FUNCTION_TRUTH = (
    "CASE function_type WHEN 'A' THEN 0 WHEN 'B' THEN 1 WHEN 'C' THEN 2 WHEN 'D' THEN 3 END"
)

# Scores of simulated runs, one per language: the rules move with the epoch.
EPOCHS = 15
RESTART = 6  # epochs that a run logs before it is started again
EPOCH_QUALITY = "CAST(n_chars >= 1600 - 150 * epoch + 20 * ((epoch * 7) % 5) AS INT)"
EPOCH_TOXIC = "CAST(doc_id % (3 + (epoch * 5) % 11) = 0 AS INT)"

SEARCH = ["the", "les", "der", "DNA", "que la", "skin", "Et"]
GROUPS = {"g1": ["the", "dna"], "g2": ["les", "skin"]}
WIDTH = 64


def category_weight(c: int, j: int) -> float:
    return ((c * 31 + j * 17) % 13 - 6) / 10


def function_weight(c: int, j: int) -> float:
    return ((c * 29 + j * 11) % 7 - 3) / 10


HEADS = (
    [[category_weight(c, j) for j in range(WIDTH)] for c in range(8)],
    [c * 0.01 for c in range(8)],
    [[function_weight(c, j) for j in range(WIDTH)] for c in range(4)],
    [c * 0.01 for c in range(4)],
)


# Keywords by the thousand: all runs of so many words of the benchmark texts.
RUN_WORDS = (3, 10)


def keyword_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(pos, keyword)` of the distinct runs, in code-point order."""
    run = "array_join(slice(w, i, n), ' ')"
    of_length = f"transform(filter(sequence(1, size(w)), i -> i <= size(w) - n + 1), i -> {run})"
    runs = table(spark, sf_dir, "benchmark").selectExpr("split(text, ' ') AS w").selectExpr(
        f"explode(flatten(transform(sequence({RUN_WORDS[0]}, {RUN_WORDS[1]}), n -> {of_length}))) AS keyword")
    distinct = runs.filter("trim(keyword) <> ''").distinct()
    return distinct.selectExpr("CAST(row_number() OVER (ORDER BY keyword) - 1 AS int) AS pos", "keyword")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expr} AS {name}" for name, expr in columns.items()])


def apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(table(spark, sf_dir, "documents"), APPS)


def halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Existing labelled table (with a column of its own) and new rows (with audit columns)."""
    records = apps(spark, sf_dir)
    is_old = "CAST(app_id AS BIGINT) % 3 = 0"
    existing = records.filter(is_old).selectExpr("*", "concat('r', country) AS labeled_by")
    new = records.filter(f"NOT ({is_old})").selectExpr(
        "*", "CAST(0.5 AS DOUBLE) AS min_confidence", "'' AS minority_candidate"
    )
    return existing, new


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(table(spark, sf_dir, "pages"), DETAILS)


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(labelled_documents(spark, sf_dir), JUDGED)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id", "embedding", "label", *[f"{e} AS {n}" for n, e in VECTOR_LABELS.items()]
    )
