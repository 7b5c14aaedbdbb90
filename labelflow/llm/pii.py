"""Personal data in whole texts: plain patterns, and the same patterns behind disguises.

A transducer rewrites disguised characters and remembers where each written character came from:
full-width, mathematical, circled and superscript characters and Cyrillic or Greek look-alikes
become ASCII, invisible characters go, spelled digits become digits, "at" and "dot" in brackets, or
as bare words (also a spaced @) in an address that ends in a top-level domain, become @ and a full stop. The patterns run
over the rewritten text, and their spans are mapped back to the source.

Spans of the plain text always stay. A span that the rewriting reveals is added when it holds a
rewritten character and no plain span of its kind covers it whole; so it may overlap the remnant
that the plain patterns find of a disguised address or number.

Null and empty texts have no span. Every step is linear in the length of a text but for the sort of
its spans.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelflow.llm.common import CHUNK_CHARS, map_batches, release, sliced, texts_of
from labelflow.llm.endings import ENDINGS

KINDS = ("email", "ip", "card", "phone")
OUTPUT = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
          "spans string, n_added long")

# Plain patterns ---------------------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can't start inside a run of digits: it would also start at the run's first digit.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @: its left run starts the match."""
    found, free = [], 0
    at = text.find("@")
    while at >= 0:
        end = at + 1
        if at >= free and at > 0 and text[at - 1] in _LOCAL and (m := _DOMAIN.match(text, at + 1)):
            start = at
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                found.append((start, m.end()))
                free = end = m.end()
        at = text.find("@", end)
    return found


def _is_ip(match: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in match.split("."))


def _is_card(match: str) -> bool:
    digits = [int(c) for c in match if c.isdigit()]
    if not 16 <= len(digits) <= 19:
        return False
    doubled = [d * 2 - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


def _is_phone(match: str) -> bool:
    return 8 <= sum(c.isdigit() for c in match) <= 15


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans `(kind, start, end)` by kind and start, in code points."""
    out = []
    if "@" in text:
        out += [("email", a, b) for a, b in _emails(text)]
    for kind, pattern, valid in (("ip", _IP, _is_ip), ("card", _CARD, _is_card), ("phone", _PHONE, _is_phone)):
        if kind != "phone" or "+" in text:
            out += [(kind, *m.span()) for m in pattern.finditer(text) if valid(m.group())]
    return out


# Disguises --------------------------------------------------------------------------------------

# Letters of other scripts that look like a Latin one.
_LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T",
    "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "υ": "u", "Α": "A", "Β": "B", "Ε": "E",
    "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y",
    "Χ": "X", "․": ".", "。": ".", "｡": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-",
    " ": " ", " ": " ", " ": " ", " ": " ", "　": " ",
}
_INVISIBLE = "­͏᠎​‌‍⁠⁡⁢⁣⁤︎️﻿"

# Digits as words of the four languages of the corpus.
_DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
    "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6",
    "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7",
    "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6",
    "siete": "7", "ocho": "8", "nueve": "9",
}
_AT_WORDS, _DOT_WORDS = "at|arobase|arroba|ät", "dot|punkt|point|punto"
# Fixed values: "us at example.com" is no address, and "at this point in" is no host.
_PROSE = frozenset("us is are was were be him them it look looking and or here available online found visit".split())
_NO_HOST = frozenset("this that the some any which what one a an no each every my his her its our your their".split())
# "at home.It": a sentence without a space, not an ending.
_STARTS = frozenset("Am As At Be By Do In Is It Me My No So To Us De Es La Si Et Il".split())

_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
_AT_BRACKET = rf"[ \t]*+{_OPEN}[ \t]*+(?:{_AT_WORDS}|@)[ \t]*+{_CLOSE}[ \t]*+"
_DOT_BRACKET = rf"[ \t]*+{_OPEN}[ \t]*+(?:{_DOT_WORDS}|\.)[ \t]*+{_CLOSE}[ \t]*+"
_BRACKETED = re.compile(rf"(?P<at>{_AT_BRACKET})|(?P<dot>{_DOT_BRACKET})", re.I)
# name at host dot com: found from the "at", so the scan stays linear.
_BARE = re.compile(
    rf"(?<=[A-Za-z0-9_%+-])(?P<at>[ \t]++(?:{_AT_WORDS})[ \t]++|[ \t]*+@[ \t]*+)"
    rf"(?P<host>[A-Za-z0-9-]++(?:(?:[ \t]++(?:{_DOT_WORDS})[ \t]++|\.)[A-Za-z0-9-]++)+)", re.I)
_HOST_DOT = re.compile(rf"[ \t]+(?:{_DOT_WORDS})[ \t]+|\.", re.I)
_DIGITISH = "|".join(sorted(map(re.escape, _DIGIT_WORDS), key=len, reverse=True))
# Two neighbours at least, one of them a word; longer chains are grown from there.
_SPELLED = re.compile(
    rf"(?:\bplus[ ]++)?\b(?:{_DIGITISH}|double|triple|[0-9]++)\b"
    rf"(?:[ ,.()-]{{1,3}}(?:(?:{_DOT_WORDS}|dash|minus)[ ]++)?(?:{_DIGITISH}|double|triple|[0-9]++)\b)++", re.I)
_SPELLED_TOKEN = re.compile(rf"\b(?:plus|dash|minus|{_DOT_WORDS}|double|triple|{_DIGITISH})\b|[0-9]+|[^\w]+", re.I)
_DOT_SET = frozenset(_DOT_WORDS.split("|"))
_TRIGGER = re.compile(rf"{_OPEN}[ \t]*+(?:{_AT_WORDS}|{_DOT_WORDS}|@|\.)[ \t]*+{_CLOSE}|[ \t](?:{_DOT_WORDS})[ \t]"
                      rf"|[ \t]@|@[ \t]|[ \t](?:{_AT_WORDS})[ \t]++[A-Za-z0-9-]++\.[A-Za-z]"
                      rf"|\b(?:{_DIGITISH})[ ,.()-]{{1,3}}(?:{_DIGITISH}|double|triple|[0-9])", re.I)


@lru_cache(maxsize=1 << 16)
def _plain(c: str) -> str:
    """What a single character stands for."""
    if c in _INVISIBLE:
        return ""
    if c in _LOOK_ALIKES:
        return _LOOK_ALIKES[c]
    folded = unicodedata.normalize("NFKC", c)
    if folded != c and folded.isascii():
        return folded.strip("().") or folded
    if unicodedata.category(c) == "Nd":
        return str(unicodedata.digit(c))
    return c


class Rewritten:
    """A text with the source span and a changed mark of each of its characters."""

    def __init__(self, text: str):
        self.text = text
        self.start = range(len(text))
        self.end = range(1, len(text) + 1)
        self.changed = bytes(len(text))

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Non-overlapping edits `(start, end, new text)` in order."""
        if not edits:
            return
        parts, start, end, changed, at = [], [], [], bytearray(), 0
        for a, b, new in edits:
            parts += [self.text[at:a], new]
            start += self.start[at:a]
            end += self.end[at:a]
            changed += self.changed[at:a]
            if new:
                # The whole disguise is the source of what it stands for.
                start += [self.start[a]] * len(new)
                end += [self.end[b - 1]] * len(new)
                changed += b"\1" * len(new)
            elif changed:
                changed[-1] = 1
            at = b
        parts.append(self.text[at:])
        start += self.start[at:]
        end += self.end[at:]
        changed += self.changed[at:]
        self.text, self.start, self.end, self.changed = "".join(parts), start, end, bytes(changed)


def _spelled_edit(match: re.Match) -> list[tuple[int, int, str]]:
    """Edits that turn one chain of spelled digits into digits without gaps."""
    base, edits, repeat, words = match.start(), [], 1, 0
    for t in _SPELLED_TOKEN.finditer(match.group()):
        a, b, low = base + t.start(), base + t.end(), t.group().lower()
        if low in ("double", "triple"):
            repeat = 2 if low == "double" else 3
            edits.append((a, b, ""))
        elif low in _DIGIT_WORDS:
            edits.append((a, b, _DIGIT_WORDS[low] * repeat))
            repeat, words = 1, words + 1
        elif low == "plus":
            edits.append((a, b, "+"))
        elif low in ("dash", "minus"):
            edits.append((a, b, "-"))
        elif low in _DOT_SET:
            edits.append((a, b, "."))
        elif low[0].isdigit():
            if repeat > 1:
                edits.append((a, b, low[0] * (repeat - 1) + low))
            repeat = 1
        elif "." not in low or low.strip():
            kept = "." if low.strip() == "." and len(low) == 1 else ""
            edits.append((a, b, kept))
    return edits if words else []


def _bare_edits(match: re.Match) -> list[tuple[int, int, str]]:
    """Edits of "name at host dot com" up to its last label that is an ending; none without one."""
    host, base = match.group("host"), match.start("host")
    dots, end = list(_HOST_DOT.finditer(host)), len(host)
    while dots:
        label = host[dots[-1].end():end]
        if label.lower() in ENDINGS and not (dots[-1].group() == "." and label in _STARTS):
            break
        end = dots.pop().start()
    spelled = [d for d in dots if d.group() != "."]
    if not dots or match.group("at") == "@" and not spelled:
        return []
    if not spelled:
        before = re.search(r"[A-Za-z0-9._%+-]*$", match.string[max(0, match.start() - 20):match.start()])
        if before.group().lower() in _PROSE:
            return []
    elif len(dots) == 1 and spelled[0].group().strip().lower() != "dot" and host[:dots[0].start()].lower() in _NO_HOST:
        return []
    return [(*match.span("at"), "@"), *((base + d.start(), base + d.end(), ".") for d in spelled)]


def rewrite(text: str) -> Rewritten | None:
    """The text without disguises; None where it has none."""
    got = Rewritten(text)
    if not text.isascii():
        odd = {c: _plain(c) for c in set(text) if not c.isascii()}
        odd = {c: p for c, p in odd.items() if p != c}
        if odd:
            pattern = re.compile("[" + "".join(map(re.escape, odd)) + "]")
            got.replace([(m.start(), m.end(), odd[m.group()]) for m in pattern.finditer(text)])
    if _TRIGGER.search(got.text):
        got.replace([(m.start(), m.end(), "@" if m.group("at") else ".") for m in _BRACKETED.finditer(got.text)])
        edits = []
        for m in _BARE.finditer(got.text):
            edits += _bare_edits(m)
        got.replace(edits)
        got.replace([e for m in _SPELLED.finditer(got.text) for e in _spelled_edit(m)])
    return got if any(got.changed) else None


def all_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Plain spans, and the ones that the rewriting adds."""
    base = find_spans(text)
    plain = rewrite(text)
    if plain is None:
        return base, []
    added = []
    taken = {k: sorted((a, b) for kind, a, b in base if kind == k) for k in KINDS}
    for kind, a, b in find_spans(plain.text):
        if 1 not in plain.changed[a:b]:
            continue
        span = (plain.start[a], plain.end[b - 1])
        if not _covered(taken[kind], span):
            added.append((kind, *span))
    return base, added


def _covered(taken: list[tuple[int, int]], span: tuple[int, int]) -> bool:
    """Whether one of the spans, which don't overlap each other, holds all of `span`."""
    from bisect import bisect_right

    at = bisect_right(taken, (span[0], float("inf")))
    return at > 0 and taken[at - 1][1] >= span[1]


def joined(spans: list[tuple[str, int, int]]) -> str:
    order = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in order)


def detect(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its spans as `OUTPUT`; the four counts and the digest are of the plain spans."""
    def run(batches):
        for b in batches:
            out = {name: [] for name in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added")}
            for t in b["text"]:
                base, added = all_spans(t)
                for kind in KINDS:
                    out[f"n_{kind}"].append(sum(s[0] == kind for s in base))
                out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                out["spans"].append(joined(base + added))
                out["n_added"].append(len(added))
            yield {"doc_id": b["doc_id"], **out}

    return map_batches(texts_of(docs, key, text), run, OUTPUT)


def masked(text: str) -> str:
    """The text with each span, or group of overlapping spans, as `<KIND>` of its first span."""
    base, added = all_spans(text)
    parts, at = [], 0
    for kind, a, b in sorted(base + added, key=lambda s: (s[1], -s[2])):
        if a < at:
            if b > at:
                at = b  # overlaps the span before: no character of it stays
            continue
        parts += [text[at:a], f"<{kind.upper()}>"]
        at = b
    return "".join(parts) + text[at:]


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """The table with personal data in `text` replaced; null stays null, other columns stay.

    A task holds the Python strings of about `CHUNK_CHARS` bytes, or of one longer text.
    """
    schema = docs.schema
    names = docs.columns

    def run(batches):
        import pyarrow as pa

        for b in sliced(batches, CHUNK_CHARS):
            new = [t if t is None else masked(t) for t in b.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(new, pa.string()) if n == text else b.column(n) for n in names], names=names)
        release()

    return docs.withColumn(text, F.col(text).cast("string")).mapInArrow(run, schema)
