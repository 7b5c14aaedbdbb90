"""Benchmark decontamination by template windows, with DataFrame functions only.

A text becomes a row of tokens without case and punctuation. Numbers, names (capitalised words
inside a sentence) and units behind a number become typed placeholders; the rest stays as it is.
Windows of eight template tokens are hashed and joined with the benchmark's, and so are windows of
the plain lower-case words without placeholders: they find copies in any case. Matching windows of a
document and an item that lie on one diagonal (same distance of the two positions) must fill the
placeholders consistently: one value of the item stands for one value of the document, and the other
way round. So the same question with other numbers or names is found, while the same frame around
unrelated values is not. Where two pairs of values contradict each other, the one with more places
on the diagonal holds (neither of two equal ones), and only the windows with a place of the other
are lost. One number of the item may stand for several: two of its numbers can be equal by chance.
Windows with the item's own values and windows of plain words always hold. A document is contaminated by an item when
consistent windows cover `COVERED` of its tokens, or half of a shorter item (at least one window).

Template windows with fewer than four plain words carry too little and are left out; windows of plain
words have no such bound. An item of fewer tokens than a window is one window as a whole. The fewer
its words, the more it must stand alone to be told from prose: five to seven tokens from the begin to
the end of sentences, three or four of lines, one or two of the document. Letters of scripts without spaces are a token each. Null and empty texts are clean. Rows that repeat get the same answer each.
An item counts by its id; repeated items are found once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelflow.scale import materialize

WINDOW, PLAIN_WORDS, COVERED = 8, 4, 16
# Items from this length are found as whole lines of a document, shorter ones as a whole document.
INSIDE = 3
# Items from this length, and shorter than a window, are found as whole sentences.
SENTENCE = 5
# Windows or keys that go to every task, 16 to 32 bytes each; more of them are joined by shuffle.
BROADCAST_ROWS = 200_000

# Units that become a placeholder behind a number.
UNITS = ("mm cm m km inch inches foot feet ft yard yards mile miles mg g gram grams kg kilogram kilograms lb lbs "
         "pound pounds ounce ounces oz ton tons ml l liter liters litre litres gallon gallons second seconds sec "
         "minute minutes min hour hours day days week weeks month months year years dollar dollars euro euros cent "
         "cents usd eur percent degree degrees kmh mph watt watts kw volt volts hz mb gb tb").split()

# Control characters can't be in a token of their own: the text's are removed with the punctuation.
_NAME, _NUMBER, _UNIT = "\x02", "\x03", "\x04"
# Each pattern begins with what is rare in a text, and looks back from there.
# Before it, all white space is one space.
_NAME_PATTERN = r"\p{Lu}(?<=[\p{Ll}\p{Nd},;)] \p{Lu})[\p{L}'’-]*"
# Marks, and white space that is not one space.
_NO_SPACE = r"[\x02-\x04\h\v]{2,}|[\x02-\x04\h\v&&[^ ]]"
_INSIDE_NUMBER = r"[.,](?<=\p{Nd}[.,])(?=\p{Nd})"
_LINE_END = r"\v+"
# A mark with white space behind it (and brackets or quotes between), a full-width one, or a line's end.
_SENTENCE_END = r"[.!?:;…]++[\p{Pe}\p{Pf}\p{Pi}\"']*+(?=\s|$)|[。！？；：]|\v+"
_END = "\x05"
# Thai, Lao, Burmese, Khmer, kana and Han, with what follows a letter on top of it.
_UNSPACED = "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]\\p{M}*"
_BETWEEN_WORDS = r"[^\p{L}\p{Nd}\p{M}\x02]+"


def _words(text: Column) -> Column:
    """Lower-case words in one string with single spaces; names are marked, values kept."""
    cleared = F.regexp_replace(F.coalesce(text, F.lit("")), _NO_SPACE, " ")
    named = F.regexp_replace(cleared, _NAME_PATTERN, _NAME + "$0")
    whole = F.regexp_replace(F.lower(named), _INSIDE_NUMBER, "")
    spaced = F.regexp_replace(whole, _UNSPACED, " $0 ")
    return F.trim(F.regexp_replace(spaced, _BETWEEN_WORDS, " "))


def _template(words: Column) -> Column:
    """The same words with placeholders, one for one."""
    names = F.regexp_replace(words, _NAME + "[^ ]*", _NAME)
    numbers = F.regexp_replace(names, r"\p{Nd}(?<=^\p{Nd}| \p{Nd})[^ ]*", _NUMBER)
    return F.regexp_replace(numbers, rf"{_NUMBER} (?:{'|'.join(UNITS)})(?![^ ])", f"{_NUMBER} {_UNIT}")


def _tokens(words: Column) -> Column:
    return F.when(words == "", F.array().cast("array<string>")).otherwise(F.split(words, " "))


def _ends(text: Column, end: str) -> Column:
    """Places of the words, from 0, at which a line or sentence begins, and the number of words."""
    cleared = F.regexp_replace(F.coalesce(text, F.lit("")), "[\x02-\x05]", " ")
    marked = F.regexp_replace(cleared, end, f" {_END} ")
    spaced = F.regexp_replace(F.regexp_replace(F.lower(marked), _INSIDE_NUMBER, ""), _UNSPACED, " $0 ")
    tokens = _tokens(F.trim(F.regexp_replace(spaced, r"[^\p{L}\p{Nd}\p{M}\x05]+", " ")))
    marks = F.array_compact(F.transform(tokens, lambda t, i: F.when(t == _END, i)))
    # Each mark takes a place of its own.
    return F.array_union(F.transform(marks, lambda p, k: p - k), F.array(F.lit(0), F.size(tokens) - F.size(marks)))


def _plain(words: Column) -> Column:
    """The same words without marks, one for one."""
    return F.replace(words, F.lit(_NAME), F.lit(""))


def _hashed(tokens: Column) -> Column:
    """Hash of each token, so that windows are hashes of numbers."""
    return F.transform(tokens, lambda t: F.xxhash64(t))


def _window(hashed: Column, at: Column, length: int = WINDOW) -> Column:
    """Hash of the window that begins at place `at`, from 0; null where the text ends before it."""
    hashes = F.xxhash64(*(F.get(hashed, at + j) for j in range(length)))
    return F.when(at + length <= F.size(hashed), hashes)


def _windows(hashed: Column) -> Column:
    """Hash of each window, by its place from 0; empty for texts shorter than a window."""
    places = F.sequence(F.lit(0), F.greatest(F.size(hashed) - WINDOW, F.lit(0)))
    return F.array_compact(F.transform(places, lambda i: _window(hashed, i)))


def _whole(hashed: Column) -> Column:
    """Hash of a short text as a whole, unlike that of any window; null for others."""
    return F.when(F.size(hashed).between(1, INSIDE - 1), F.xxhash64(F.lit("whole"), hashed))


def _small(df: DataFrame, rows: int) -> DataFrame:
    """A written table, to be broadcast when it has at most `rows` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def benchmark_windows(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """`(w, item_id, version, ipos, exact)` of every window, templates with enough plain words only, and the items' tokens.

    `exact` windows hash the words themselves, as a template without a placeholder does.
    """
    items = benchmark.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("item_id"), _words(F.col(text)).alias("words")
    ).distinct()
    # Repeated ids with several texts are several versions of one item.
    items = items.select(
        "item_id", F.xxhash64("words").alias("version"), _tokens(F.col("words")).alias("item_values"),
        _tokens(_template(F.col("words"))).alias("tokens"),
    )
    plain = F.size(F.filter(F.slice("tokens", F.col("ipos") + 1, WINDOW),
                            lambda t: ~t.isin(_NAME, _NUMBER, _UNIT)))
    templates = items.withColumn("hashed", _hashed(F.col("tokens"))).select(
        "item_id", "version", "tokens", F.posexplode(_windows(F.col("hashed"))).alias("ipos", "w")
    ).filter((plain >= PLAIN_WORDS) & (plain < WINDOW))
    n = F.size("hashed")
    short = [F.when(n == k, _window(F.col("hashed"), F.lit(0), k)) for k in range(INSIDE, WINDOW)]
    own = F.when(n >= WINDOW, _windows(F.col("hashed"))).otherwise(
        F.array_compact(F.array(*short, _whole(F.col("hashed")))))
    words = items.withColumn("hashed", _hashed(F.transform("item_values", _plain))).select(
        "item_id", "version", "tokens", F.posexplode(own).alias("ipos", "w"))
    kept = [df.select("w", "item_id", "version", "ipos", F.lit(exact).alias("exact"))
            for df, exact in ((templates, False), (words, True))]
    return kept[0].unionByName(kept[1]), items


def _places(at: Column) -> Column:
    """The places that windows from `at` cover."""
    return F.array_distinct(F.flatten(F.transform(at, lambda p: F.sequence(p, p + (WINDOW - 1)))))


def _let(value: Column, body) -> Column:
    """`body(value)`, the value computed once: a column that a lambda names once would be put into it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _within(places: Column, p: Column) -> Column:
    """Whether the window from `p` holds one of the places."""
    return F.exists(places, lambda b: (b >= p) & (b < p + WINDOW))


def _contradict(x: Column, y: Column) -> Column:
    """Whether pair `y` speaks against `x` at no fewer places."""
    a, b = x["pair"], y["pair"]
    split = (a["mine"] == b["mine"]) & (a["theirs"] != b["theirs"]) & (a["kind"] != _NUMBER)
    merged = (a["mine"] != b["mine"]) & (a["theirs"] == b["theirs"])
    return (a["kind"] == b["kind"]) & (y["n"] >= x["n"]) & (split | merged)


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
               item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """`(doc_id, h, item_id, covered, item_tokens, reparameterised)` of contaminated documents.

    `h` is the hash of the text: together with the id it names a row up to exact repetition.
    """
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"),
        F.col(text).alias("text"),
    )
    windows, items = benchmark_windows(benchmark, item_key, item_text)
    known = materialize(windows, "benchmark-windows")
    lengths = sorted(r.n for r in items.select(F.size("tokens").alias("n")).filter(
        F.col("n").between(1, WINDOW - 1)).distinct().collect())  # seven at most
    words = rows.select("doc_id", "h", _words(F.col("text")).alias("words"))
    hashed = words.select("doc_id", "h", *(
        _hashed(_tokens(f(F.col("words")))).alias(name) for name, f in (("w", _template), ("v", _plain))))
    # Rows for places first: hashes of plain columns are compiled code, those inside a lambda are not.
    inside = [n for n in lengths if n >= INSIDE]
    last = F.size("v") - min([*inside, WINDOW])
    placed = hashed.select("*", F.explode(F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).alias("dpos"))
    at, v = F.col("dpos"), F.col("v")
    # Short items, where there are any: their own lengths, and whole rows below `INSIDE`.
    short = [_window(v, at, n) for n in inside]
    if lengths and lengths[0] < INSIDE:
        short.append(F.when(at == 0, _whole(v)))
    windows = placed.select("doc_id", "h", "dpos", _window(F.col("w"), at).alias("w"), _window(v, at).alias("v"),
                            *(w.alias(f"s{i}") for i, w in enumerate(short)))
    # A window without a placeholder is the same both ways, and is looked up once.
    each = F.array("w", F.when(F.col("w") != F.col("v"), F.col("v")), *(f"s{i}" for i in range(len(short))))
    exploded = windows.select("doc_id", "h", "dpos", F.explode(each).alias("w")).filter(F.col("w").isNotNull())
    hits = exploded.join(_small(known, BROADCAST_ROWS), "w").select(
        "doc_id", "h", "item_id", "version", "dpos", "ipos", "exact").distinct()
    hits = materialize(hits, "window-hits")

    # The values behind the placeholders, of the few documents with a hit only.
    wanted = materialize(hits.select("doc_id", "h").distinct(), "hit-documents")
    same = F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("dh") == F.col("h"))
    found = rows.join(_small(wanted.withColumnsRenamed({"doc_id": "d", "h": "dh"}), BROADCAST_ROWS), same, "left_semi")
    ends = {"lines": _LINE_END, "sentences": _SENTENCE_END} if inside else {}
    values = found.distinct().select(
        "doc_id", "h", _tokens(_words(F.col("text"))).alias("doc_values"),
        *(_ends(F.col("text"), end).alias(name) for name, end in ends.items()))

    diagonals = hits.groupBy("doc_id", "h", "item_id", "version", (F.col("dpos") - F.col("ipos")).alias("shift")).agg(
        # At most the item's length each.
        F.collect_set(F.when(~F.col("exact"), F.col("ipos"))).alias("at"),
        F.collect_set(F.when(F.col("exact"), F.col("ipos"))).alias("exact_at"))
    joined = diagonals.withColumn("places", _places(F.col("at"))).alias("a").join(
        values.alias("b"), F.expr("a.doc_id <=> b.doc_id AND a.h = b.h")
    ).select("a.*", "b.doc_values", *(f"b.{name}" for name in ends)).join(items, ["item_id", "version"])
    if inside:
        n, begin = F.size("tokens"), F.col("shift")
        alone = F.when(n >= SENTENCE, F.col("sentences")).otherwise(F.col("lines"))
        joined = joined.filter(~n.between(INSIDE, WINDOW - 1) | (
            F.array_contains(alone, begin) & F.array_contains(alone, begin + n)))
    slots = F.filter(
        F.transform("places", lambda p: F.struct(
            p.alias("place"), F.get("tokens", p).alias("kind"), F.get("item_values", p).alias("mine"),
            F.get("doc_values", p + F.col("shift")).alias("theirs"))),
        lambda s: s["kind"].isin(_NAME, _NUMBER, _UNIT))
    pair = lambda s: F.struct(s["kind"].alias("kind"), s["mine"].alias("mine"), s["theirs"].alias("theirs"))
    checked = joined.withColumn("slots", slots).withColumn(
        "pairs", F.array_distinct(F.transform("slots", pair))
    ).withColumn(
        # As many distinct pairs as distinct values on either side: one for one.
        "consistent",
        (F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda s: F.struct(s["kind"], s["mine"]))))) &
        (F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda s: F.struct(s["kind"], s["theirs"]))))),
    ).withColumn(
        "counted", F.when(~F.col("consistent"), F.transform("pairs", lambda x: F.struct(
            x.alias("pair"), F.size(F.filter("slots", lambda s: pair(s) == x)).alias("n"))))
    ).withColumn(
        "altered", F.transform(F.filter("slots", lambda s: s["mine"] != s["theirs"]), lambda s: s["place"])
    ).withColumn(
        "held", F.when(F.col("consistent"), F.col("at")).otherwise(_let(
            F.transform(F.filter("counted", lambda x: F.exists("counted", lambda y: _contradict(x, y))),
                        lambda x: x["pair"]),
            lambda against: _let(
                F.transform(F.filter("slots", lambda s: F.array_contains(against, pair(s))), lambda s: s["place"]),
                lambda bad: F.filter("at", lambda p: ~_within(bad, p) | ~_within(F.col("altered"), p)))))
    ).withColumn("held_places", F.array_union(_places(F.col("held")), _places(F.col("exact_at")))).withColumn(
        "changed", F.exists("held", lambda p: _within(F.col("altered"), p)))
    per_item = checked.filter(F.size("held_places") > 0).groupBy("doc_id", "h", "item_id", "version").agg(
        # The window of a short item ends with it.
        F.least(F.size(F.array_distinct(F.flatten(F.collect_set("held_places")))),
                F.max(F.size("tokens"))).alias("covered"),
        F.max(F.size("tokens")).alias("item_tokens"),
        F.bool_or("changed").alias("reparameterised"),
    )
    enough = F.least(F.lit(COVERED), F.greatest(F.lit(WINDOW), F.ceil(F.col("item_tokens") / 2)), F.col("item_tokens"))
    return per_item.filter(F.col("covered") >= enough).groupBy("doc_id", "h", "item_id").agg(
        F.max("covered").alias("covered"), F.max("item_tokens").alias("item_tokens"),
        F.bool_or("reparameterised").alias("reparameterised"))


def _of_documents(leaks: DataFrame) -> DataFrame:
    per_doc = leaks.groupBy(F.col("doc_id").alias("d"), F.col("h").alias("dh")).agg(
        F.count(F.lit(1)).alias("n_items"), F.min_by("item_id", F.struct(-F.col("covered"), "item_id")).alias("item_id"),
        F.max("covered").alias("covered"), F.bool_or("reparameterised").alias("reparameterised"))
    return _small(materialize(per_doc, "leaks"), BROADCAST_ROWS)


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: `doc_id, contaminated, n_items, item_id, covered, reparameterised`.

    `item_id` is the item that is covered most, the smallest of equal ones; null for clean rows.
    """
    found = _of_documents(find_leaks(docs, benchmark, key, text))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"),
                       F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"))
    same = F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("dh") == F.col("h"))
    return rows.join(found, same, "left").select(
        "doc_id", F.col("d").isNotNull().alias("marked"), F.col("dh").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"), "item_id", F.coalesce("covered", F.lit(0)).alias("covered"),
        F.coalesce("reparameterised", F.lit(False)).alias("reparameterised"),
    ).drop("marked")


def without_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that no item contaminates, with all their columns."""
    found = _of_documents(find_leaks(docs, benchmark, key, text))
    same = F.col("_leak.d").eqNullSafe(F.col(f"_docs.{key}").cast("long")) & (
        F.col("_leak.dh") == F.xxhash64(F.coalesce(F.col(f"_docs.{text}"), F.lit(""))))
    return docs.alias("_docs").join(found.alias("_leak"), same, "left_anti")
