"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from conftest import SMALL

from labelflow.llm import variants


def distance_is_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, ratio=5):
    forms, rows = {}, []
    for w, n in counts.items():
        near = sorted((-counts[v], v) for v in counts if distance_is_one(w, v))
        form = near[0][1] if near and counts[near[0][1]] >= ratio * n else None
        forms[w] = form
        rows.append((w, form, n, len(near)))
    out = []
    for w, form, n, near in rows:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, form, root, n, near, None if form is None else counts[form]))
    return sorted(out)


def random_words(seed, n, alphabet="abcß"):
    r = random.Random(seed)
    words = {}
    while len(words) < n:
        if words and r.random() < 0.6:
            w = list(r.choice(list(words)))
            at = r.randrange(len(w))
            kind = r.randrange(3)
            w[at:at + (kind != 0)] = [r.choice(alphabet)] if kind != 1 else []
            w = "".join(w)
        else:
            w = "".join(r.choice(alphabet) for _ in range(r.choice([1, 2, 3, 6, 7, 8, 9, 12, 20])))
        if w:
            words.setdefault(w, r.choice([1, 2, 5, 5, 10, 25, 30, 130, 700]))
    return words


def result(df):
    return sorted(tuple(r) for r in df.select(*variants.OUTPUT).collect())


@pytest.mark.parametrize("seed, panels, rows", [(1, 3, 512), (2, 3, 4), (3, 2, 3), (4, 1, 16), (5, 5, 512)])
def test_groups_equal_brute_force(spark, monkeypatch, seed, panels, rows):
    monkeypatch.setattr(variants, "TILE_ROWS", rows)  # small tiles deal a block to many groups
    counts = random_words(seed, 400)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert result(variants.group_variants(words, panels=panels)) == brute(counts)


def test_a_common_beginning_is_dealt_to_tiles(spark, monkeypatch):
    monkeypatch.setattr(variants, "TILE_ROWS", 8)
    r = random.Random(9)
    counts = {"common" + "".join(r.choice("ab") for _ in range(7)): r.choice([5, 30, 200]) for _ in range(300)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    tiles = variants.tiles(words).groupBy("m", "panel", "block", "left", "right").count()
    assert tiles.agg({"count": "max"}).first()[0] < 60 < len(counts)
    assert result(variants.group_variants(words)) == brute(counts)


def test_long_words_get_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(variants, "TILE_CODES", 3000)
    base = "ab" * 700
    counts = {base: 100, base[:900] + base[901:]: 5, base + "c": 7, "x" + base: 30, base[:-1]: 1}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert result(variants.group_variants(words)) == brute(counts)


def naive_counts(rows, modulus):
    counts = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{low}".encode())
            if modulus and h % modulus == 0:
                at = h % len(low)
                low = low[:at] + low[at + 1:]
            counts[low] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


@pytest.mark.parametrize("damage", [None, 2, 199])
def test_words_of_documents(spark, monkeypatch, damage):
    monkeypatch.setattr(variants, "HELD_WORDS", 20)
    monkeypatch.setattr(variants, "LONG_TEXT", 200)
    rows = [(i, f"Straße STRASSE straßen Größen-größen {'a' * (i % 9)}bcdefg ÀÉcdefg x{i}") for i in range(40)]
    rows += [(None, "Nobody nobody"), (3, None), (4, ""), (5, "!!! 12 ..."), (3, "Straße " * 50), (3, "Straße " * 50)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int")
    want = brute(naive_counts(rows, damage))
    assert want and result(variants.variants(docs, damage=damage)) == want


def test_ties_and_repeats_and_nothing(spark):
    counts = {"abcdef": 5, "abcdeg": 25, "abcdeh": 25, "zzzzzz": 9}
    got = {r.word: (r.form, r.n_near) for r in variants.group_variants(
        spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert got == {"abcdef": ("abcdeg", 2), "abcdeg": (None, 2), "abcdeh": (None, 2), "zzzzzz": (None, 0)}
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert variants.variants(docs).count() == 0


def test_whole_small_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    counts = naive_counts(rows, variants.DAMAGE)
    got = result(variants.variants(docs, damage=variants.DAMAGE))
    assert {r[0]: r[3] for r in got} == counts
    some = dict(list(sorted(counts.items()))[:300])
    assert result(variants.group_variants(spark.createDataFrame(list(some.items()), "word string, n long"))) == brute(some)
