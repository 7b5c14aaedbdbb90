import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from labelflow.operators.candidates import (
    discovery_order,
    first_keyword,
    keyword_yield,
    search,
    top_hits,
)
from labelflow.operators.details import found_details, missing_details, normalize_records
from labelflow.plans.collect import collect_records, find_candidates, in_discovery_order
from labelflow.schema import CANONICAL_COLUMNS
from labelflow.sources.keywords import keyword_table, read_keywords

KEYWORDS = ["aa", "ab c", "É", "zzz", "B"]


def corpus(n=300, seed=7):
    rng = random.Random(seed)
    return [(i, "".join(rng.choice("aabcé É") for _ in range(rng.randint(0, 40)))) for i in range(n)]


def brute_hits(texts):
    return [
        (pos, k, i, t.lower().count(k.lower()))
        for pos, k in enumerate(KEYWORDS) for i, t in texts if k.lower() in t.lower()
    ]


def brute_top(texts, n):
    out = []
    for pos, k in enumerate(KEYWORDS):
        mine = sorted((h for h in brute_hits(texts) if h[0] == pos), key=lambda h: (-h[3], h[2]))[:n]
        out += [(*h, rank) for rank, h in enumerate(mine, 1)]
    return out


def frame(spark, texts, parts=5):
    return spark.createDataFrame(texts, "doc long, text string").repartition(parts)


def test_search_finds_every_match(spark):
    texts = corpus() + [(999, None)]
    got = rows(search(frame(spark, texts), "doc", F.col("text"), KEYWORDS))
    assert got == sorted(brute_hits(corpus()), key=repr)


def test_blank_keywords_are_an_error(spark):
    with pytest.raises(ValueError):
        search(frame(spark, corpus(3)), "doc", F.col("text"), ["a", " "])


@pytest.mark.parametrize("parts", [1, 9])
def test_top_hits_do_not_depend_on_partitioning(spark, parts):
    hits = search(frame(spark, corpus(), parts), "doc", F.col("text"), KEYWORDS)
    assert rows(top_hits(hits, 7)) == sorted(brute_top(corpus(), 7), key=repr)


def test_first_keyword_with_repeated_ids(spark):
    texts = [(i % 50, t) for i, t in corpus()]
    hits = search(frame(spark, texts), "doc", F.col("text"), KEYWORDS)
    firsts = {}
    for pos, k, i, _ in sorted(brute_hits(texts)):
        firsts.setdefault(i, (i, pos, k))
    assert rows(first_keyword(hits, KEYWORDS)) == sorted(firsts.values(), key=repr)


def test_yield_counts_hits_and_new_ids(spark):
    hits = search(frame(spark, corpus()), "doc", F.col("text"), KEYWORDS)
    seen, expected = set(), []
    for pos, k in enumerate(KEYWORDS):
        ids = [h[2] for h in brute_hits(corpus()) if h[0] == pos]
        new = set(ids) - seen
        seen |= new
        expected.append((pos, k, len(ids), len(new), len(seen)))
    got = keyword_yield(hits, keyword_table(spark, KEYWORDS)).orderBy("pos")
    assert [tuple(r) for r in got.collect()] == expected


def test_collection_keeps_discovery_order_and_reports_misses(spark):
    texts = corpus()
    known = {i for i, _ in texts if i % 3}
    details = spark.createDataFrame(
        [(str(i), None if i % 2 else f"t{i}", "", None, "" if i % 5 else f"u{i}") for i in sorted(known)],
        "app_id string, title string, description string, genre string, url string",
    )
    named = frame(spark, texts).withColumn("app", F.col("doc").cast("string"))
    found = find_candidates(named, "app", F.col("text"), KEYWORDS, 7)
    order = {}
    for pos, k in enumerate(KEYWORDS):
        mine = [h for h in brute_hits(texts) if h[0] == pos]
        for rank, h in enumerate(sorted(mine, key=lambda h: (-h[3], str(h[2])))[:7], 1):
            order.setdefault(str(h[2]), (pos, rank))
    assert {r.app_id: (r.pos, r.hit_rank) for r in found.collect()} == order
    records, missing = collect_records(found, details)
    listed = [r.app_id for r in in_discovery_order(records, found).collect()]
    assert listed == [i for i in order if int(i) in known]
    assert {r.app_id for r in missing.collect()} == {i for i in order if int(i) not in known}


def test_normalized_record(spark):
    details = spark.createDataFrame(
        [("a.b", None, None, "Health", None), ("c", "T", "D", None, ""), ("d", "", "", "", "http://x")],
        "app_id string, title string, description string, genre string, url string",
    )
    got = {r.app_id: r for r in normalize_records(details, "ko", "kr").collect()}
    assert normalize_records(details).columns == CANONICAL_COLUMNS
    assert got["a.b"].store_url.endswith("?id=a.b&hl=ko&gl=KR")
    assert got["c"].store_url.endswith("?id=c&hl=ko&gl=KR")
    assert got["d"].store_url == "http://x"
    assert (got["a.b"].app_name, got["a.b"].description, got["a.b"].genre) == ("", "", "Health")
    assert {got["c"][c] for c in CANONICAL_COLUMNS[7:]} == {None}
    assert (got["c"].platform, got["c"].country) == ("android", "kr")
    assert normalize_records(details).schema["is_boundary_case"].dataType.typeName() == "boolean"


def test_repeated_ids_take_one_slot(spark):
    hits = spark.createDataFrame(
        [(0, "k", "a", 1)] * 40 + [(0, "k", "b", 3), (0, "k", "c", 2)], "pos int, keyword string, id string, score long")
    got = sorted((r.hit_rank, r.id, r.score) for r in top_hits(hits, 3).collect())
    assert got == [(1, "a", 40), (2, "b", 3), (3, "c", 2)]


def test_repeated_details_give_one_record(spark):
    found = spark.createDataFrame([("a",), ("b",)], "app_id string")
    details = spark.createDataFrame([("a", "T2"), ("a", "T1"), ("c", "T")], "app_id string, title string")
    assert [tuple(r) for r in found_details(found, details).collect()] == [("a", "T1")]
    assert [r.app_id for r in missing_details(found, details).collect()] == ["b"]


def test_keyword_files_follow_each_other(spark, tmp_path):
    (tmp_path / "1.txt").write_text("x1\n\nx2\n")
    (tmp_path / "2.txt").write_text("y1\ny2")
    got = sorted(map(tuple, read_keywords(spark, str(tmp_path)).collect()))
    assert got == [(0, "x1"), (1, "x2"), (2, "y1"), (3, "y2")]


def test_one_keyword_matching_everything_is_ranked_in_parts(spark):
    texts = frame(spark, [(i, "aa" * (1 + i % 4)) for i in range(5000)], 16)
    hits = search(texts, "doc", F.col("text"), ["aa"])
    best = top_hits(hits, 3)
    assert [r.id for r in best.orderBy("hit_rank").collect()] == [3, 7, 11]
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 3
    assert discovery_order(best).count() == 3
