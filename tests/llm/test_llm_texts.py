"""Operators that work on each text alone, against brute force and the named libraries."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from conftest import SMALL

from pyspark.sql import functions as F

from labelflow.llm import idfile, language, lm, main_text, pii, queries, token_counts
from labelflow.llm.common import fold

PIECES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")

# Null, empty, blank, repeated and clashing rows; the last columns are named like results.
ODD = [
    (1, "Hello world, hello.", 7, "x"), (2, None, 7, "x"), (3, "", 7, "x"), (4, " \n\t ", 7, "x"),
    (5, "Hello world, hello.", 7, "x"), (5, "Hello world, hello.", 7, "x"), (None, "no id here", 7, "x"),
    (6, "word " * 30_000, 7, "x"), (7, "x" * 60_000, 7, "x"), (8, "日本 é <s>|##|<|endoftext|> ok", 7, "x"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, n_tokens int, score string")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def random_texts(alphabet, n, longest, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice(alphabet) for _ in range(r.randrange(longest))) for _ in range(n)]


# Token counts -----------------------------------------------------------------------------------


def test_piece_counts_equal_the_library():
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=PIECES)
    texts = random_texts([*" \n\t▁abcdethe", "  ", "é", "ß", "梦", "ａ", "\0", "<s>", "😀", "ing", "1"], 300, 120)
    texts += ["", " ", "a" * 2000, "ab" * 900, " " * 1500, "梦" * 700]
    assert token_counts.count_texts(texts, PIECES) == [len(x) for x in model.encode(texts)]


def test_ragged_merging_equals_the_heap():
    merger, _ = token_counts.load(PIECES)
    words = [w for t in random_texts([*"abcdefghing▁the"], 200, 60, 3) for w in [t] if w]
    symbols = [merger.symbols(w) for w in words]
    flat = np.array([s for x in symbols for s in x])
    got = merger._count_ragged(flat, np.array([len(x) for x in symbols]))
    assert got.tolist() == [merger._count_long(x) for x in symbols]


def test_token_counts_of_odd_rows(spark, odd, none):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=PIECES)
    got = sorted(map(tuple, token_counts.token_counts(odd, PIECES).collect()), key=repr)
    want = []
    for i, t, *_ in ODD:
        n = len(model.encode(t or ""))
        want.append((i, len((t or "").encode()), n, n > 4096))
    assert got == sorted(want, key=repr)
    assert token_counts.token_counts(none, PIECES).count() == 0


# Token ids --------------------------------------------------------------------------------------


def test_ids_equal_the_library():
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(BYTES)
    texts = random_texts(["a", "b", " ", "  ", "\n", "'s", "é", "12", "!", "　", "\x1c", "<|endoftext|>", "日"], 800, 25)
    got = [x.tolist() for x in idfile.encode_texts(texts, BYTES)]
    assert got == [model.encode(t, add_special_tokens=False).ids + [2] for t in texts]


@pytest.mark.parametrize("most", [30, 400_000])
def test_ids_from_remembered_words_equal_the_library(monkeypatch, most):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(BYTES)
    monkeypatch.setattr(idfile, "CACHED", most)
    cache = idfile._encoder(BYTES)[3]
    cache.clear()
    long = "x" * (idfile.LONG_WORD + 1)
    for n in range(12):
        texts = random_texts(["a", "b", "cd", " ", " ", " e ", "\n", "é", "日", f" {n}", f" {long} ", "f\n\n"], 20 + n, 25)
        texts += ["foo end\n\n", "\n\nfoo bar", "", "foo"]
        got = [x.tolist() for x in idfile.encode_texts(texts, BYTES)]
        assert got == [model.encode(t, add_special_tokens=False).ids + [2] for t in texts]
        assert len(cache.words) == len(cache.ids) <= most
        assert long not in cache.words.to_pylist() and len(set(cache.words.to_pylist())) == len(cache.words)
    cache.clear()


def test_id_files_round_trip(spark, odd, none, tmp_path):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(BYTES)
    manifest = idfile.write_ids(odd, BYTES, folder=str(tmp_path), shards=3)
    got = sorted((tuple(r) for r in idfile.read_ids(manifest).collect()), key=lambda r: (r[1], repr(r)))
    assert [r[0] for r in got] == [None, 1, 2, 3, 4, 5, 5, 6, 7, 8]  # null first, then ascending
    texts, at = {i: t or "" for i, t, *_ in ODD}, 0
    for doc_id, start, n, crc in got:
        ids = [*model.encode(texts[doc_id], add_special_tokens=False).ids, 2]
        assert (start, n, crc) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += n
    assert idfile.read_ids(idfile.write_ids(none, BYTES, folder=str(tmp_path / "none"))).count() == 0


def test_keyed_access_finds_each_key_and_no_other(spark, odd, tmp_path):
    manifest = idfile.write_ids(odd, BYTES, folder=str(tmp_path), shards=1).collect()
    shard = idfile.Shard(manifest[0].path)
    assert shard.get(1).tolist() == idfile.encode_texts([ODD[0][1]], BYTES)[0].tolist()
    assert shard.get(5, 1).tolist() == shard.get(5, 0).tolist() and shard.get(5, 2) is None
    assert shard.get(None) is not None and all(shard.get(i) is None for i in range(100, 400))


def test_perfect_hash_is_minimal():
    keys = np.arange(5000)
    hashes = idfile.key_hash(keys, keys < 0, keys * 0, 1)
    assert sorted(idfile.PerfectHash.build(hashes, 1).slots(hashes).tolist()) == keys.tolist()
    assert idfile.PerfectHash.build(np.array([7, 7], dtype=np.uint64), 1) is None


# Personal data ----------------------------------------------------------------------------------


def plain_spans(text):
    luhn = lambda d: sum(x if k % 2 == 0 else x * 2 - 9 * (x > 4) for k, x in enumerate(reversed(d))) % 10 == 0
    digits = lambda s: [int(c) for c in s if c.isdigit()]
    rules = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
    )
    return [(k, *m.span()) for k, p, ok in rules for m in re.finditer(p, text) if ok(m.group())]


@pytest.mark.parametrize("alphabet", ["a@.-1 ", "0123456789.+ ()-", "a.@b1+@", "1234567890 -"])
def test_plain_spans_equal_the_patterns(alphabet):
    for t in random_texts(alphabet, 4000, 40):
        assert pii.find_spans(t) == plain_spans(t), t


@pytest.mark.parametrize("text, hidden", [
    ("write john.doe [at] example [dot] com now", "john.doe [at] example [dot] com"),
    ("mail john at mail dot example dot com ok", "john at mail dot example dot com"),
    ("ｊoe@ехample.com", "ｊoe@ехample.com"),
    ("j​oe@exam​ple.com", "j​oe@exam​ple.com"),
    ("plus one four one five, five five five one two three four now",
     "plus one four one five, five five five one two three four"),
    ("＋１ ４１５ ５５５ １２３４ x", "＋１ ４１５ ５５５ １２３４"),
    ("ip one nine two dot one six eight dot one dot one", "one nine two dot one six eight dot one dot one"),
])
def test_disguised_spans_map_back(text, hidden):
    base, added = pii.all_spans(text)
    assert [text[a:b] for _, a, b in added] == [hidden] and base == []
    assert hidden not in pii.masked(text)


@pytest.mark.parametrize("hidden", [
    "john at example.com", "john @ example.com", "john at firma dot se", "john at firma dot jp", "john at mail.firma dot ru",
    "john at firma dot online",
])
def test_bare_addresses_of_all_endings(hidden):
    text = f"so {hidden}, thanks"
    base, added = pii.all_spans(text)
    assert base == [] and [text[a:b] for _, a, b in added] == [hidden]


@pytest.mark.parametrize("text", ["they were at this point in time", "visit us at example.com", "we sat at home.It was late"])
def test_prose_with_at_stays(text):
    assert pii.all_spans(text) == ([], [])


@pytest.mark.parametrize("hidden, remnant", [
    ("jo\u0435.smith@example.com", ".smith@example.com"),
    ("joe@example.c\u043em", "joe@example.c"),
    ("+44 20 7946 \uff10\uff19\uff15\uff18", "+44 20 7946"),
])
def test_disguised_spans_are_kept_beside_their_plain_remnant(hidden, remnant):
    text = f"so {hidden} it is"
    base, added = pii.all_spans(text)
    assert [text[a:b] for _, a, b in base] == [remnant] and [text[a:b] for _, a, b in added] == [hidden]
    assert pii.masked(text) in ("so <EMAIL> it is", "so <PHONE> it is")


def test_revealed_spans_inside_a_plain_span_are_not_added():
    base, added = pii.all_spans("\uff41 joe@example.com 4111\u20111111\u20111111\u20111111")
    assert [k for k, *_ in base] == ["email"] and [k for k, *_ in added] == ["card"]


@pytest.mark.parametrize("text", [
    "look at the dot product", "we were at one two three", "(at) home", "one of two at three", "a+b = c. 3.5 at 4",
])
def test_clean_texts_stay(text):
    assert pii.all_spans(text) == ([], []) and pii.masked(text) == text


def test_detection_of_odd_rows(spark, odd, none):
    rows = [(i, (t or "") + " a.b@c.de 1.2.3.4", n, s) for i, t, n, s in ODD] + ODD
    df = spark.createDataFrame(rows, odd.schema)
    for r in pii.detect(df).collect():
        mails = r.n_email
        assert r.n_ip == mails and r.n_card == r.n_phone == r.n_added == 0
        assert r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest() and bool(r.spans) == bool(mails)
    assert pii.detect(none).count() == 0
    kept = pii.mask(odd).collect()
    assert sorted(map(repr, kept)) == sorted(map(repr, odd.collect()))  # nothing to mask


# Language ---------------------------------------------------------------------------------------


def test_profiles_and_distances_equal_brute_force(spark):
    from collections import Counter

    texts = {"aa": ["abba abab! baab", "ab ba"], "bb": ["xyz zyx", "zz xyxy xx"]}
    df = spark.createDataFrame([(t, k) for k, v in texts.items() for t in v], "text string, lang string")
    got = language.learn_profiles(df.selectExpr("1L AS doc_id", "*"), top=7)

    def grams(t):
        for word in re.findall(r"[a-z]+", t):
            yield from word
            w = f"_{word}_"
            yield from (w[i:i + 2] for i in range(len(w) - 1))
            yield from (w[i:i + 3] for i in range(len(w) - 2))

    def number(g):
        codes = [0 if c == "_" else ord(c) for c in g]
        if len(g) == 1:
            return codes[0]
        if len(g) == 2:
            return codes[0] << 21 | codes[1] | 1 << 42 | 1 << 62
        return codes[0] << 42 | codes[1] << 21 | codes[2]

    def ranked(ts):
        counts = Counter(number(g) for t in ts for g in grams(t))
        return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:7]]

    assert got == {k: ranked(v) for k, v in texts.items()}
    profiles = language.Profiles(got, 7)
    for text in ("abab", "xx yz", "abx", "q"):
        mine = ranked([text])
        far = {k: sum(abs(i - p.index(g)) if g in p else 7 for i, g in enumerate(mine)) for k, p in got.items()}
        best = min(far, key=lambda k: (far[k], k))
        assert profiles.predict(text) == (best, pytest.approx(1 - far[best] / (7 * len(mine))))


def test_long_texts_are_counted_in_pieces(monkeypatch):
    codes = language.letter_codes("the quick brown fox jumps " * 50)
    whole = language.gram_counts(codes)
    monkeypatch.setattr(language, "CHUNK_CHARS", 37)
    assert all((a == b).all() for a, b in zip(whole, language.gram_counts(codes)))


def test_language_of_held_out_documents(spark, none):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = queries.QUERIES["op10_language_id"](spark, SMALL).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == docs.count() and len(held) > 20
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    odd = spark.createDataFrame([(1, "12 34 !", "en"), (2, None, "en"), (3, "the one", None), (4, "", "de")],
                                "doc_id long, text string, lang string")
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(odd).collect()}
    assert by_id[1] == by_id[2] == by_id[4] == ("und", 0.0)
    assert language.identify(none).count() == 0


# Pages ------------------------------------------------------------------------------------------


def test_article_without_its_surroundings():
    page = ("<html><head><title>T</title><style>p{}</style></head><body><header><a href=/>Home</a></header>"
            "<nav><ul><li><a href=a>A</a></li></ul></nav><div class='cookie-notice'>We use cookies to make this site "
            "work as it should for all of our many readers.</div><article><h1>Head &amp; line</h1><p>First <b>long</b>\n"
            " text of the article, with enough words to count.<br>Next<p>Second &eacute;<script>var a='</p>';</script>"
            "<div class='ad'>Buy this now</div></article><section class=comments><p>A reader says that this is a long and "
            "thoughtful comment on the article above.</p></section><aside>Other</aside><form><label>Mail</label></form>"
            "<footer>&copy; us</footer></body></html>")
    assert main_text.extract(page) == (
        "Head & line\nFirst long text of the article, with enough words to count. Next\nSecond é")


def test_cut_equals_the_best_labelling():
    r = random.Random(2)
    for _ in range(60):
        n = r.randrange(1, 8)
        scores = [r.uniform(-3, 3) for _ in range(n)]
        edges = [(r.randrange(n), r.randrange(n), r.uniform(0, 2)) for _ in range(n)]
        edges = [e for e in edges if e[0] != e[1]]

        def cost(x):
            return sum(abs(s) for s, keep in zip(scores, x) if keep != (s > 0)) + sum(c for a, b, c in edges if x[a] != x[b])

        best = min(cost([m >> i & 1 == 1 for i in range(n)]) for m in range(1 << n))
        assert cost(main_text.minimum_cut(scores, edges)) == pytest.approx(best)


def test_pages_of_all_kinds(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "plain &amp; simple"), (4, "u", "<p>" * 5000 + "x"), (4, "u", "<a <b <!-- "),
            (None, "u", "<div>" * 2000 + "deep text")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'t' AS text")
    got = {r.page_id: r for r in main_text.main_texts(df).collect()}
    assert got[1].text == got[2].text == "" and got[3].text == "plain & simple" and got[None].n_chars == 9
    assert main_text.main_texts(df.limit(0)).count() == 0


def test_pages_equal_their_articles(spark):
    from html import unescape

    for r in spark.read.parquet(f"{SMALL}/pages.parquet").limit(50).collect():
        inside = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        parts = (" ".join(unescape(re.sub(r"<[^>]+>", " ", p)).split()) for p in re.split(r"</?p>|</?h1>", inside))
        assert main_text.extract(r.html) == "\n".join(p for p in parts if p)


# Language model ---------------------------------------------------------------------------------


def test_base_scores_equal_brute_force_and_the_model_is_better(spark):
    import math
    from collections import Counter

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    counts = Counter(w for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1 for w in lm.words_of(t))
    n, v = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in queries.QUERIES["op1_lm_scores"](spark, SMALL).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        words, r = lm.words_of(t), got[i]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(counts[w] > 0 for w in words), n)
        assert r.base_score == pytest.approx(base) and r.held_out == (zlib.crc32(str(i).encode()) % 5 == 1)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_class_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    model = lm.Model(rng.uniform(0, 100, lm.CLASSES))
    model.train(rng.integers(0, lm.CLASSES, 6000), rng)
    normalisers = model.normalisers()
    for near, far in ((0, 0), (5, 300)):
        ids = np.arange(lm.CLASSES)
        hidden = model.r[near] @ model.c[0] + model.r[far] @ model.c[1]
        logs = hidden @ model.q[ids].T + model.b[ids] - normalisers[near, far]
        assert np.exp(logs.astype(float)).sum() == pytest.approx(1.0, abs=1e-4)


def test_scores_of_odd_rows(spark, odd, none):
    got = [r for r in lm.score_texts(odd).collect()]
    assert len(got) == len(ODD) and all(np.isfinite([r.score, r.base_score]).all() for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (2, 3, 4)} == {1}
    assert lm.score_texts(none).count() == 0
    only_held = odd.filter(fold("doc_id") == 1)
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in lm.score_texts(only_held).collect())


def test_languages_of_rows_with_any_columns(spark):
    docs = spark.createDataFrame(
        [(1, "the house and the garden", "x", 7, "en"), (2, "das Haus und der Garten", "y", 8, "de"), (3, None, "z", 9, None)],
        "doc_id long, text string, _text string, `a ``tick` int, lang string")
    profiles = language.learn_profiles(docs)
    got = {r.doc_id: r for r in language.predict_languages(docs, profiles).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["en", "de", "und"]
    assert [got[i]["a `tick"] for i in (1, 2, 3)] == [7, 8, 9] and got[1]._text == "x"


def brute_known(rows, top=language.TOP):
    """Rows that stay, by plain counting."""
    grams = {}
    for _, t, lang in rows:
        if lang is not None:
            grams.setdefault(lang, Counter()).update(plain_grams(t or ""))
    profiles = {lang: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], order(x[0])))[:top]] for lang, c in grams.items()}
    scored = []
    for i, t, lang in rows:
        mine = [g for g, _ in sorted(Counter(plain_grams(t or "")).items(), key=lambda x: (-x[1], order(x[0])))[:top]]
        if not mine or not any(profiles.values()):
            scored.append((i, lang, "und" if not mine else None, 0.0))
            continue
        cost = {}
        for name, p in profiles.items():
            place = {g: k for k, g in enumerate(p)}
            cost[name] = sum(abs(place[g] - k) if g in place else top for k, g in enumerate(mine))
        best = min(sorted(cost), key=cost.get)
        scored.append((i, lang, best, 1 - cost[best] / (top * len(mine))))
    borders = {}
    for _, lang, best, score in scored:
        if lang is not None and best not in (None, "und"):
            borders[best] = min(score, borders.get(best, 1.0))
    return sorted(i for i, _, best, score in scored if best != "und" and score >= borders.get(best, 0.0))


def plain_grams(text):
    coded = [c if c.isalpha() else " " for c in text.lower()]
    s = re.sub(" +", " ", " " + "".join(coded) + " ")
    one = [c for c in s if c != " "]
    two = [s[i:i + 2] for i in range(len(s) - 1)]
    three = [s[i:i + 3] for i in range(len(s) - 2) if s[i + 1] != " "]
    return (one + two + three) if one else []


def order(gram):
    """The operator's own order of equally frequent n-grams: its numbers for them."""
    codes = [0 if c == " " else ord(c) for c in gram]
    if len(codes) == 1:
        return codes[0]
    if len(codes) == 2:
        return (codes[0] << 21) | codes[1] | (1 << 42) | (1 << 62)
    return (codes[0] << 42) | (codes[1] << 21) | codes[2]


def test_rows_of_known_languages_equal_brute_force(spark):
    r = random.Random(8)
    english, german = "the house and garden with an apple tree".split(), "das Haus und der Garten mit einem Baum".split()
    rows = [(i, " ".join(r.choice(english) for _ in range(r.randrange(1, 30))), r.choice(["en", "en", None])) for i in range(60)]
    rows += [(100 + i, " ".join(r.choice(german) for _ in range(r.randrange(1, 30))), r.choice(["de", None])) for i in range(60)]
    rows += [(200 + i, "".join(r.choice("qxzwjkvy ") for _ in range(r.randrange(1, 60))), None) for i in range(60)]
    rows += [(300, None, "en"), (301, "", None), (302, "12 34!", "de"), (303, "12", None), (1, rows[1][1], rows[1][2])]
    docs = spark.createDataFrame([(*row, "mine", 0.5) for row in rows], "doc_id long, text string, lang string, lang_pred string, score double")
    kept = language.with_known_language(docs)
    assert kept.columns == docs.columns and {(x.lang_pred, x.score) for x in kept.collect()} == {("mine", 0.5)}
    got = sorted(x.doc_id for x in kept.collect())
    assert got == brute_known(rows) and 60 < len(got) < 180
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    letters = sorted(i for i, t, _ in rows if t and any(c.isalpha() for c in t))
    assert sorted(x.doc_id for x in language.with_known_language(none).collect()) == letters


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_predictions_are_written_without_texts(spark, monkeypatch, broadcast):
    r = random.Random(10)
    words = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randrange(2, 9))) for _ in range(3000)]
    rows = [(i, " ".join(r.choice(words) for _ in range(500)), "en") for i in range(80)]
    rows += [(100 + i, "".join(r.choice("qxzwjkvyþøłж ") for _ in range(2500)), None) for i in range(40)]
    # A label decides about a short text only, and each row has its own.
    rows += [(200, "þø łж", "en"), (201, "þø łж", None), (202, "", "en"), (203, None, "en"), (204, rows[0][1], None)]
    written, materialize = [], language.materialize
    monkeypatch.setattr(language, "materialize", lambda *a: written.append(materialize(*a)) or written[-1])
    monkeypatch.setattr(language, "BROADCAST_ROWS", broadcast)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    got = sorted(x.doc_id for x in language.with_known_language(docs).collect())
    assert got == [*range(80), 200, 204]
    size = sum(os.path.getsize(f.removeprefix("file://")) for table in written for f in table.inputFiles())
    assert size < 0.1 * sum(len(t or "") for _, t, _ in rows)


def test_labelled_noise_sets_no_border_and_goes(spark):
    r = random.Random(9)
    english, german = "the house and garden with an apple tree".split(), "das Haus und der Garten mit einem Baum".split()
    rows = [(i, " ".join(r.choice(english) for _ in range(40)), "en") for i in range(60)]
    rows += [(100 + i, " ".join(r.choice(german) for _ in range(40)), "de") for i in range(60)]
    noise = [(200 + i, "".join(r.choice("qxzwjkvyþøłж ") for _ in range(200)), r.choice(["en", "de", None])) for i in range(9)]
    copies = [(300 + i, rows[0][1], "en") for i in range(300)]
    docs = spark.createDataFrame(rows + noise + copies, "doc_id long, text string, lang string")
    got = sorted(x.doc_id for x in language.with_known_language(docs).collect())
    assert got == sorted(i for i, *_ in rows + copies)


def test_release_gives_freed_memory_back():
    from labelflow.llm.common import release

    def anonymous():
        with open("/proc/self/smaps_rollup") as f:
            return int(re.search(r"Pss_Anon:\s+(\d+)", f.read())[1]) // 1024

    held = [bytes(1000) for _ in range(200_000)]
    last = held.pop()  # the pieces before it stay with the process
    del held
    before = anonymous()
    release()
    assert len(last) == 1000 and anonymous() < before - 100


def words(r, n):
    return " ".join(r.choice("river stone garden winter letter bridge market morning silver window".split()) for _ in range(n))


SHELLS = [
    "<html><head><title>x</title><body><article>{}</article></body></html>",
    "<html><head><meta charset=utf-8><title>x</title><link rel=a><article>{}</article>",
    "<div class='content has-sidebar'>{}</div>", "<div id='page' class='nav-open'><article>{}</article></div>",
    "<article class='post category-social tag-legal comments-open'>{}</article>", "<main class='site-main no-sidebar'>{}</main>",
    "<form id='aspnetForm'><div class='content'>{}</div></form>", "<div class='widget wrapper'><main>{}</main></div>",
    "<body class='login menu'><div class='post'>{}</div></body>",
]
AROUND = [
    "<nav><a href=/>Home</a> <a href=/b>News of the day</a></nav>", "<div class='cookie-notice'>We use cookies for a better site.</div>",
    "<footer>Copyright of this site, all rights reserved</footer>", "<aside class=sidebar><a href=/c>More to read</a></aside>",
    "<div class=comments><p>Great text, thanks for it!</p></div>",
]


@pytest.mark.parametrize("shell", range(len(SHELLS)))
def test_articles_survive_their_shells(shell):
    r = random.Random(shell)
    harmless = ["no-widget", "has-ads", "tag-share", "category-search", "sidebar-left", "is-modal", "u12", "status-closed", "menu-closed"]
    for _ in range(40):
        parts = [words(r, r.randrange(15, 60)) for _ in range(r.randrange(2, 6))]
        article = "".join(f"<p class='{r.choice(harmless)}'>{t}</p>" for t in parts)
        head, sep, rest = SHELLS[shell].partition("{}")
        inner = f"<div class='{' '.join(r.sample(harmless, 2))}'>{article}</div>"
        before, after = ("".join(r.sample(AROUND, r.randrange(3))) for _ in range(2))
        if "<body" in head or "<head" in head or "form" in head or "page" in head:
            before = ""
        page = before + head + inner + rest + after
        assert main_text.extract(page) == "\n".join(parts), page


def test_words_in_formulas_and_labels():
    page = "<article><p>The sum <math><mi>a</mi><mo>+</mo><mi>b</mi></math> of <label>two words</label> is here.</p></article>"
    assert main_text.extract(page) == "The sum a+b of two words is here."
    form = "<article><p>A text that stays on the page as it is.</p></article><form><label>Name</label><input></form>"
    assert main_text.extract(form) == "A text that stays on the page as it is."
