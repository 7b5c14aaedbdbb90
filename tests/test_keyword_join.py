"""The search for long lists against a plain search and brute force."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from labelflow.operators import keyword_join
from labelflow.operators.candidates import search
from labelflow.plans import collect
from labelflow.sources.keywords import read_keywords


def table(spark, keywords):
    return spark.createDataFrame(list(enumerate(keywords)), "pos int, keyword string")


def corpus(seed, n=200):
    r = random.Random(seed)
    letters = "aabcé É😀ß"
    return [(i % 150, "".join(r.choice(letters) for _ in range(r.choice([0, 1, 3, 8, 40, 120])))) for i in range(n)]


def brute(texts, keywords):
    return sorted(((p, k, i, (t or "").lower().count(k.lower())) for p, k in enumerate(keywords)
                   for i, t in texts if t and k.lower() in t.lower()), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, monkeypatch, seed):
    if seed == 2:
        monkeypatch.setattr(keyword_join, "PART_BYTES", 20_000)  # many parts
    texts = corpus(seed) + [(7, None), (8, "")]
    r = random.Random(seed)
    whole = "".join(t or "" for _, t in texts)
    keywords = ["aaaaaaaa", "aaaaa", "É", "zzzz", "not there at all", "😀😀", "B", "aa"]
    for n in (1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 20):
        for _ in range(15):
            at = r.randrange(len(whole) - n)
            keywords.append(whole[at:at + n])
    keywords = [k for k in dict.fromkeys(keywords) if k.strip()]
    df = spark.createDataFrame(texts, "doc long, text string").repartition(5)
    got = rows(keyword_join.search_many(df, "doc", F.col("text"), table(spark, keywords)))
    assert got == brute(texts, keywords)
    assert got == rows(search(df, "doc", F.col("text"), keywords))


def test_text_is_not_shuffled_and_nothing_is_multiplied(spark, capsys):
    df = spark.createDataFrame(corpus(4), "doc long, text string")
    keyword_join.search_many(df, "doc", F.col("text"), table(spark, ["abcabca", "aab"])).explain("formatted")
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan
    assert not any(word in plan for word in ("Cartesian", "NestedLoop", "SortMergeJoin"))


def test_no_keywords_and_blank_ones(spark):
    df = spark.createDataFrame(corpus(5, 10), "doc long, text string")
    none = keyword_join.search_many(df, "doc", F.col("text"), table(spark, []))
    assert none.count() == 0 and none.columns == ["pos", "keyword", "id", "score"]
    for bad in (" ", "", None):
        with pytest.raises(ValueError):
            keyword_join.search_many(df, "doc", F.col("text"), table(spark, ["a", bad]))


@pytest.mark.parametrize("literals", [200, 3])
def test_candidates_of_a_keyword_table(spark, monkeypatch, literals):
    monkeypatch.setattr(collect, "LITERAL_KEYWORDS", literals)
    keywords = ["aab", "É", "bca", "cé a", "aa"]
    df = spark.createDataFrame([(str(i), t) for i, t in corpus(6)], "app string, text string")
    listed = rows(collect.find_candidates(df, "app", F.col("text"), keywords, 9))
    assert rows(collect.find_candidates(df, "app", F.col("text"), table(spark, keywords), 9)) == listed
    gaps = table(spark, keywords).withColumn("pos", F.col("pos") * 10)
    assert [r[1] for r in rows(collect.find_candidates(df, "app", F.col("text"), gaps, 9))] == [r[1] * 10 for r in listed]


def test_keyword_files_are_numbered_through(spark, tmp_path):
    for name, lines in (("a.txt", ["x1", "", "x2"]), ("b.txt", []), ("c.txt", ["y1", " ", "y2", "y3"])):
        (tmp_path / name).write_text("\n".join(lines))
    assert rows(read_keywords(spark, str(tmp_path))) == [(0, "x1"), (1, "x2"), (2, "y1"), (3, "y2"), (4, "y3")]


def test_no_row_is_made_for_a_gram(spark, capsys):
    df = spark.createDataFrame(corpus(7), "doc long, text string")
    keyword_join.search_many(df, "doc", F.col("text"), table(spark, ["abcabca", "aab"])).explain("formatted")
    plan = capsys.readouterr().out
    assert "MapInArrow" in plan
    assert not any(word in plan for word in ("Generate", "Exchange hashpartitioning"))


def test_long_keywords_overlaps_and_repeated_rows(spark):
    long = "the quick brown fox jumps over the lazy dog"
    texts = [(1, f"{long} {long.upper()} {long[:-1]}"), (1, "ab" * 30), (2, "x" + "ab" * 9), (2, None)]
    keywords = [long, long[3:27], long[:16], long[5:16], long[5:14], "ab" * 12, "abab", "ba" * 8, long[:-1] + "x"]
    df = spark.createDataFrame(texts, "doc long, text string")
    twice = table(spark, keywords).union(table(spark, keywords[:2]))
    assert rows(keyword_join.search_many(df, "doc", F.col("text"), twice)) == brute(texts, keywords)
