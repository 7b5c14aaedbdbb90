"""One query for each operator, over its whole table and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelflow.llm import (
    decontaminate,
    idfile,
    jaccard,
    language,
    lm,
    main_text,
    neighbours,
    notices,
    packing,
    pii,
    token_counts,
    variants,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_lm_scores(spark, sf_dir):
    return lm.score_texts(table(spark, sf_dir, "documents"))


@query
def op2_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


@query
def op3_main_text(spark, sf_dir):
    return main_text.main_texts(table(spark, sf_dir, "pages"))


@query
def op4_token_ids(spark, sf_dir):
    manifest = idfile.write_ids(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
    return idfile.read_ids(manifest)


@query
def op5_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op6_neighbours(spark, sf_dir):
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op7_pii(spark, sf_dir):
    return pii.detect(table(spark, sf_dir, "documents"))


@query
def op8_decontamination(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_jaccard_join(spark, sf_dir):
    return jaccard.classes(table(spark, sf_dir, "documents"))


@query
def op10_language_id(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op11_spelling_variants(spark, sf_dir):
    return variants.variants(table(spark, sf_dir, "documents"), damage=variants.DAMAGE)


@query
def op12_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op13_license_scan(spark, sf_dir):
    return notices.scan(table(spark, sf_dir, "documents"))


# SQL of the operators that it can express; the others are tested against brute force.
ORACLE = {
    "op9_jaccard_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
                ELSE list_distinct([w[i:i + 4] for i in range(1, len(w) - 3)]) END AS s
            FROM words),
        items AS MATERIALIZED (SELECT doc_id, len(s) AS n, md5(CAST(unnest(s) AS VARCHAR)) AS g FROM sets),
        links AS MATERIALIZED (
            SELECT a.doc_id AS x, b.doc_id AS y
            FROM items a JOIN items b ON a.g = b.g AND a.doc_id <> b.doc_id
                AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
            GROUP BY a.doc_id, b.doc_id, a.n, b.n
            HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
        reach AS (
            SELECT doc_id AS x, doc_id AS y FROM documents
            UNION
            SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
        SELECT s.doc_id, len(s.s) AS n_shingles, min(r.y) AS component_id
        FROM sets s JOIN reach r ON r.x = s.doc_id GROUP BY s.doc_id, len(s.s)
    """,
}
