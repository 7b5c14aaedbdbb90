"""License scans: base columns against plain code, notices against edit distances of all spans."""

import random
import re

import pytest
from conftest import SMALL

from labelflow.llm import notices


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", low)


def plain_base(text):
    words = plain_words(text)
    places, labels = [], set()
    for phrase, label in notices.PHRASES:
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def least_edits(text, notice):
    """The fewest edits of any row of whole words whose name stands within its own bound."""
    name = notice[notice.find("{") + 1:notice.find("}")] if "{" in notice else ""
    whole = notice.replace("{", "").replace("}", "")
    words, best = plain_words(text), None
    for i in range(len(words)):
        for j in range(i + 1, len(words) + 1):
            span = " ".join(words[i:j])
            if abs(len(span) - len(whole)) > notices.MOST_EDITS:
                continue
            e = edits(span, whole)
            inside = span.split()
            named = not name or any(
                edits(" ".join(inside[a:b]), name) <= len(name) // 6
                for a in range(len(inside)) for b in range(a + 1, len(inside) + 1))
            if named and (best is None or e < best):
                best = e
    return best


def damaged(r, text, n):
    t = list(text)
    for _ in range(n):
        at, kind = r.randrange(len(t)), r.randrange(3)
        t[at:at + (kind != 0)] = [r.choice("aeinst ")] if kind != 1 else []
    return "".join(t)


@pytest.mark.parametrize("notice, label", [n for n in notices.NOTICES if len(n[0]) < 45])
def test_found_where_edits_allow(notice, label):
    r = random.Random(notice)
    bound = notices.Notice(notice, label).edits
    found = 0
    for _ in range(120):
        inner = damaged(r, notice.replace("{", "").replace("}", ""), r.randrange(bound + 3))
        text = f"Some words; {inner}, more words"
        least = least_edits(text, notice)
        got = notices.Found(text, (), ((notice, label),)).notices
        assert bool(got) == (least is not None and least <= bound), (text, least, got)
        found += bool(got)
    assert 20 < found < 120


TEXTS = [
    None, "", "...", "Released under the MIT License.", "mit\nLICENSE mit-license", "admit license", "CC BY CC-BY cc_by",
    "GNU General Public License; gnu general public licence", "Äpache license", "Apache\tLicense\x00MIT License",
    "é mit license é", "cc by cc by", "x" * 30_000 + " mit license " + "y " * 20_000, "MIT  License", "gnu  general--public/license",
]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)], "doc_id long, text string, labels string, n_words int")


def test_base_columns(spark):
    got = {r.doc_id: r for r in notices.scan(frame(spark, TEXTS)).collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_base(t), t
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert r.score == 1.0 if r.n_base else 0 <= r.score < 1


def test_base_columns_of_whole_small_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = notices.scan(docs).collect()
    assert len(rows) == docs.count() and any(r.n_base for r in rows)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_base(texts[r.doc_id])


def test_labels_of_damaged_and_other_notices():
    def labels(text):
        return sorted({n.label for *_, n in notices.Found(text).notices})

    assert labels("Relesed under the MITT Licence") == []  # names of three letters have no errors
    assert labels("Relesed under the MIT Licence") == labels("undr the MIT Licence") == ["mit"]
    assert labels("under teh Apache License") == ["apache"]
    assert labels("released under the BSD license") == ["bsd"]
    assert labels("released under the FOO license") == []
    assert labels("under the GNU Lesser General Public License") == ["lgpl"]
    assert labels("Licensed under CC BY-NC 4.0.") == ["cc-by-nc"]
    assert labels("Licenced under the Apache Licence, version 2.0") == ["apache-2.0"]
    assert labels("Permision is hereby granted, free of charge, to any person obtaining a copi of this sofware") == ["mit"]
    assert labels("we commit; license plates are under the license office") == []


def test_places_are_those_of_the_source(spark):
    text = "Intro: Ünder the MIT Licence!\n  MIT -- License. " * 3
    rows = notices.find(frame(spark, [text, None, "nothing"])).orderBy("start", "kind").collect()
    spans = [(r.kind, r.label, text[r.start:r.end], r.edits) for r in rows]
    assert spans == [("notice", "mit", "the MIT Licence", 1), ("phrase", "mit", "MIT -- License", 0)] * 3
    assert notices.find(frame(spark, [])).count() == notices.scan(frame(spark, [])).count() == 0


def test_repeated_rows_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "mit license"), (1, "mit license"), (1, "mit license")], "doc_id long, text string")
    assert [r.n_base for r in notices.scan(docs).collect()] == [1, 1, 1]
