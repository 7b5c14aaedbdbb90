"""License scans: fuzzy search for short notices, seeds first, bounded-error matching second.

A text becomes its canonical form: the words (runs of digits, letters and characters beyond ASCII,
A-Z lower-cased) with one space before, between and after them. Two kinds of matches are looked for:

* phrases, word by word and exact;
* notices, with errors. A notice of `n` characters may differ by `n // 8` edits (at least 1, at most
  `MOST_EDITS`). So many edits can't touch all of `edits + 1` pieces of the notice, so one piece
  stands in the text exactly: one pass of an Aho-Corasick automaton over all pieces finds every place
  worth a look. There the regex library looks for the notice within the bound, and if it is there
  matches the rows of whole words around it. The name in it (in braces below) must stand within
  `len(name) // 6` edits of its own, so that another license's name is no misspelling. Of matches that overlap, the one with the larger
  share of equal characters counts, then the longer, then the one further left.

A notice counts once for each place at which it matches; places of one notice don't overlap. The
score of a document is 1 with a phrase, else the largest share of equal characters of its notices
(1 - edits / length), else 0.

Every row is scanned whole and on its own: no shuffle, no state between rows. Null and empty texts
have no words, the score 0, empty labels and null places; repeated rows give a row each, an empty
table gives no rows, other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from functools import lru_cache

from pyspark.sql import DataFrame

from labelflow.llm.common import WORDS_OF_LETTERS, map_batches, texts_of

# The four phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Short notices as they are commonly written, names in braces, and their labels.
NOTICES = (
    ("under the {gnu general} public license", "gpl"),
    ("under the {gnu lesser general} public license", "lgpl"),
    ("under the {gnu affero general} public license", "agpl"),
    ("under the {apache} license version 2 0", "apache-2.0"),
    ("under the {apache} license", "apache"),
    ("the {apache} license", "apache"),
    ("under the {mit} license", "mit"),
    ("the {mit} license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("under the {bsd} license", "bsd"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("under the {mozilla} public license", "mpl"),
    ("under the {eclipse} public license", "epl"),
    ("under the {isc} license", "isc"),
    ("licensed under {cc by} 4 0", "cc-by"),
    ("licensed under {cc by sa} 4 0", "cc-by-sa"),
    ("licensed under {cc by nc} 4 0", "cc-by-nc"),
    ("licensed under {cc by nd} 4 0", "cc-by-nd"),
    ("creative commons {attribution} license", "cc-by"),
    ("this is free and unencumbered software released into the {public domain}", "unlicense"),
)
MOST_EDITS = 6
DIGEST = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, n_notices long")
SPANS = "doc_id long, kind string, label string, notice string, start long, end long, edits int"

# Word characters to themselves, A-Z to lower case, all other ASCII to spaces.
_CANONICAL = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def canonical(text: str) -> tuple[str, int]:
    """The canonical form of a text and its number of words."""
    words = text.encode("utf-8", "surrogatepass").translate(_CANONICAL).split()
    return f" {b' '.join(words).decode('utf-8', 'surrogatepass')} ", len(words)


class Notice:
    """One notice: its bound, its pieces with their places, and its patterns."""

    def __init__(self, text: str, label: str):
        import regex

        before, _, rest = text.partition("{")
        name, _, after = rest.partition("}")
        self.label, self.text = label, before + name + after
        self.edits = min(MOST_EDITS, max(1, len(self.text) // 8))
        cuts = [len(self.text) * i // (self.edits + 1) for i in range(self.edits + 2)]
        self.pieces = [(a, self.text[a:b]) for a, b in zip(cuts, cuts[1:])]
        escaped = regex.escape(self.text, literal_spaces=True)
        self.anywhere = regex.compile(f"(?:{escaped}){{e<={self.edits}}}")
        self.whole = regex.compile(f"(?b)(?:{escaped}){{e<={self.edits}}}")
        escaped = regex.escape(name, literal_spaces=True)
        self.name = regex.compile(f" (?:{escaped}){{e<={len(name) // 6}}} ") if name else None

    def places(self, form: str, seeds: list[int]) -> list[tuple[int, int, int]]:
        """`(start, end, edits)` of all rows of whole words within the bound, near the seeds.

        `seeds` are places of the canonical form at which the notice would begin. Where the notice
        stands as it is, other rows that overlap it are of no interest.
        """
        n, k = len(self.text), self.edits
        windows: list[list[int]] = []
        for at in sorted(seeds):
            low, high = max(0, at - k - 1), min(len(form), at + n + k + 1)
            if windows and low <= windows[-1][1]:
                windows[-1][1] = max(windows[-1][1], high)
            else:
                windows.append([low, high])
        found = []
        for low, high in windows:
            named = self.name is None or self.name.search(form, low, high)
            if not named or not self.anywhere.search(form, low, high):
                continue
            spaces = [i for i in range(low, high) if form[i] == " "]
            exact = {i + 1 for i in spaces if form.startswith(self.text, i + 1) and form[i + 1 + n] == " "}
            found += [(a, a + n, 0) for a in exact]
            for s in spaces:
                a = s + 1
                if any(abs(a - e) < n for e in exact):
                    continue
                for e in spaces[bisect_left(spaces, a + n - k):bisect_right(spaces, a + n + k)]:
                    m = self.whole.fullmatch(form, a, e)
                    if m and (self.name is None or self.name.search(f" {form[a:e]} ")):
                        found.append((a, e, sum(m.fuzzy_counts)))
        return found


@lru_cache(maxsize=4)
def _search(phrases, notices):
    """Automaton over phrases and pieces; a value lists (phrase, None, 0) and (None, notice, offset)."""
    import ahocorasick

    known = [Notice(text, label) for text, label in notices]
    values: dict[str, list] = {}
    for i, (phrase, _) in enumerate(phrases):
        values.setdefault(f" {phrase} ", []).append((i, None, 1))
    for n, notice in enumerate(known):
        for offset, piece in notice.pieces:
            values.setdefault(piece, []).append((None, n, offset))
    automaton = ahocorasick.Automaton()
    for word, value in values.items():
        automaton.add_word(word, (len(word), value))
    if values:
        automaton.make_automaton()
    return automaton if values else None, known


class Found:
    """What stands in one text. Places are offsets in the canonical form."""

    def __init__(self, text: str, phrases=PHRASES, notices=NOTICES):
        self.form, self.n_words = canonical(text)
        automaton, known = _search(phrases, notices)
        self.base: list[tuple[int, int]] = []  # (start, phrase)
        seeds: dict[int, set[int]] = {}
        for last, (length, values) in automaton.iter(self.form) if automaton else ():
            first = last - length + 1
            for phrase, notice, offset in values:
                if notice is None:
                    self.base.append((first + offset, phrase))
                else:
                    seeds.setdefault(notice, set()).add(first - offset)
        self.base.sort()
        matches = []
        for n, starts in seeds.items():
            notice = known[n]
            for a, b, edits in notice.places(self.form, list(starts)):
                matches.append((edits / len(notice.text), a - b, a, b, edits, n))
        self.notices: list[tuple[int, int, int, Notice]] = []  # (start, end, edits, notice)
        taken: list[tuple[int, int]] = []
        for _, _, a, b, edits, n in sorted(matches):
            if not _overlaps(taken, a, b):
                self.notices.append((a, b, edits, known[n]))
        self.notices.sort(key=lambda m: m[:2])
        shares = [1.0 for _ in self.base[:1]] + [1 - e / len(n.text) for _, _, e, n in self.notices]
        self.score = max([0.0, *shares])

    def word_of(self, place: int) -> int:
        """Number of the word that begins at a place of the canonical form."""
        return self.form.count(" ", 0, place) - 1


def _overlaps(taken: list[tuple[int, int]], a: int, b: int) -> bool:
    """Whether [a, b) meets one of the disjoint, sorted ranges; if not, it joins them."""
    i = bisect_left(taken, (a, b))
    if (i and taken[i - 1][1] > a) or (i < len(taken) and taken[i][0] < b):
        return True
    taken.insert(i, (a, b))
    return False


def scan(docs: DataFrame, phrases=PHRASES, notices=NOTICES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`, as `DIGEST`; `n_notices` counts the places of notices."""
    phrases, notices = tuple(phrases), tuple(notices)

    def run(batches):
        for b in batches:
            rows = []
            for d, t in zip(b["doc_id"], b["text"]):
                f = Found(t, phrases, notices)
                base = {phrases[p][1] for _, p in f.base}
                ends = (f.word_of(f.base[0][0]), f.word_of(f.base[-1][0])) if f.base else (None, None)
                rows.append((d, f.n_words, len(f.base), *ends, ",".join(sorted(base)),
                             ",".join(sorted(base | {n.label for *_, n in f.notices})), f.score, len(f.notices)))
            if rows:
                yield dict(zip(names, map(list, zip(*rows))))

    names = [c.split()[0] for c in DIGEST.split(", ")]
    return map_batches(texts_of(docs, key, text), run, DIGEST)


def find(docs: DataFrame, phrases=PHRASES, notices=NOTICES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per match, as `SPANS`: start and end are code points of the source text, end exclusive.

    `kind` is `phrase` or `notice`, `notice` the searched words, `edits` 0 for phrases.
    """
    phrases, notices = tuple(phrases), tuple(notices)

    def run(batches):
        for b in batches:
            rows = []
            for d, t in zip(b["doc_id"], b["text"]):
                f = Found(t, phrases, notices)
                if not (f.base or f.notices):
                    continue
                spans = [m.span() for m in WORDS_OF_LETTERS.finditer(t)]
                # Matches begin and end with words, so their words give the place in the source.
                for a, p in f.base:
                    first = f.word_of(a)
                    last = first + phrases[p][0].count(" ")
                    rows.append((d, "phrase", phrases[p][1], phrases[p][0], spans[first][0], spans[last][1], 0))
                for a, e, edits, n in f.notices:
                    first, last = f.word_of(a), f.word_of(a) + f.form.count(" ", a, e)
                    rows.append((d, "notice", n.label, n.text, spans[first][0], spans[last][1], edits))
            if rows:
                yield dict(zip(names, map(list, zip(*rows))))

    names = [c.split()[0] for c in SPANS.split(", ")]
    return map_batches(texts_of(docs, key, text), run, SPANS)
