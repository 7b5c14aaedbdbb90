"""Candidate search for long keyword lists: a q-gram filter join.

A keyword stands in a text only where its grams do. Each text gives the grams that begin at every
`stride`-th place. Wherever a long keyword stands, one of its first `stride` places falls on such a
place, so for each remainder one of its grams is enough, and the one that occurs in the texts least
often is taken. Short keywords are looked for at every place, those shorter than a gram by a gram of
their own length; long ones by longer grams, which chance seldom puts into a text, at fewer places.
The grams of texts and keywords meet as sorted numbers within the scan stage, and the whole keyword
is compared where one of its grams is found. No text is shuffled and no list multiplied out: all
places of a keyword in a text are counted where the text is read, and ids and counts leave the scan.

The keyword side goes to the tasks in parts of about `PART_BYTES`, by its counted size: a list of any
length takes one pass over the texts per part, and one more pass that counts the grams.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelflow.functions.text import has_text
from labelflow.scale import materialize

PART_BYTES = 64 << 20
_ROW_BYTES = 64  # of a row of the keyword side besides its texts
_SLICE_BYTES = 1 << 20  # of texts that are worked on at once; a longer text comes alone
_CHUNK = 1 << 18  # places, and pairs of a place and a keyword, that are compared at once
_COLUMNS = 16  # code points that are compared as columns before whole keywords are
_FILTER_BITS = 22


class Kind(NamedTuple):
    """Keywords of a range of lengths, in code points, and how texts give their grams."""

    shortest: int
    longest: int | None
    gram: int
    stride: int  # at most gram, and at most shortest - gram + 1


KINDS = [
    Kind(1, 1, 1, 1), Kind(2, 2, 2, 1), Kind(3, 3, 3, 1), Kind(4, 4, 4, 1), Kind(5, 5, 4, 2), Kind(6, 6, 4, 3),
    Kind(7, 10, 4, 4), Kind(11, 15, 8, 4), Kind(16, 23, 8, 8), Kind(24, None, 16, 8),
]

_ODD = np.uint64(0x9E3779B185EBCA87)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ (x >> np.uint64(29))) * _ODD
    return x ^ (x >> np.uint64(32))


def _grams(codes: np.ndarray, places: np.ndarray, kind: int) -> np.ndarray:
    """Hashes of the grams that begin at the places."""
    with np.errstate(over="ignore"):
        found = np.full(len(places), kind + 1, dtype=np.uint64)
        for j in range(KINDS[kind].gram):
            found = (found ^ codes[places + j]) * _ODD
            found ^= found >> np.uint64(31)
        return _mix(found)


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, one after the other, and where each begins, with the end of the last."""
    wide = [t.decode("utf-8", "replace").encode("utf-32-le", "surrogatepass") for t in texts]
    bounds = np.cumsum([0, *map(len, wide)]) // 4
    return np.frombuffer(b"".join(wide), dtype="<u4"), bounds


def _places(bounds: np.ndarray, gram: int, stride: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every `stride`-th place of each text that begins a whole gram, with the text's number, in chunks."""
    many = np.maximum(0, np.diff(bounds) - gram + stride) // stride
    ends = np.cumsum(many)
    for at in range(0, int(ends[-1]), _CHUNK):
        i = np.arange(at, min(at + _CHUNK, int(ends[-1])))
        text = np.searchsorted(ends, i, side="right")
        yield bounds[text] + (i - (ends[text] - many[text])) * stride, text


class _Sorted:
    """Sorted numbers, and where given ones are among them; bits tell most of the others first."""

    def __init__(self, grams: np.ndarray):
        self.grams = grams
        self.bits = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.bits[grams >> np.uint64(64 - _FILTER_BITS)] = True

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of `grams` are there, and the first place of each of these."""
        if not len(self.grams):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        some = np.flatnonzero(self.bits[grams >> np.uint64(64 - _FILTER_BITS)])
        at = np.searchsorted(self.grams, grams[some])
        there = self.grams[np.minimum(at, len(self.grams) - 1)] == grams[some]
        return some[there], at[there]


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in slices of about `_SLICE_BYTES`, of one row at least."""
    for b in batches:
        ends = np.cumsum([0 if t is None else len(t) for t in b["low"].to_pylist()])
        at = 0
        while at < b.num_rows:
            before = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + _SLICE_BYTES, side="right")))
            yield b.slice(at, end - at)
            at = end


def _needles(keywords: DataFrame) -> tuple[DataFrame, list[int]]:
    """Lower-cased keywords with a number and their kind, and the kinds that occur."""
    length = F.char_length("needle")
    kind = F.coalesce(*[
        F.when((length >= k.shortest) & (length <= (k.longest or (1 << 31) - 1)), F.lit(i)) for i, k in enumerate(KINDS)
    ])
    numbered = keywords.select("pos", "keyword").distinct().select(
        "pos", "keyword", F.lower("keyword").alias("needle")).withColumn("kind", kind)
    needles = materialize(numbered.withColumn("number", F.monotonically_increasing_id()), "needles")
    if not needles.filter(~has_text(F.col("needle"))).isEmpty():
        raise ValueError("blank keyword")
    return needles, sorted(r.kind for r in needles.select("kind").distinct().collect())


def _keyword_grams(needles: DataFrame) -> DataFrame:
    """`(number, residue, offset, gram)`: all grams that may stand for a keyword."""
    fields = ["number", "residue", "offset", "gram"]

    def run(batches):
        for b in _sliced(batches):
            codes, bounds = _joined(b["low"].to_pylist())
            numbers, kinds = (b[c].to_numpy(zero_copy_only=False) for c in ("number", "kind"))
            for i in np.unique(kinds).tolist():
                for place, text in _places(bounds, KINDS[i].gram, 1):
                    own = kinds[text] == i
                    place, text = place[own], text[own]
                    offset = place - bounds[text]
                    rows = [numbers[text], offset % KINDS[i].stride, offset, _grams(codes, place, i).view(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()) for r in rows], names=fields)

    low = needles.select("number", "kind", F.col("needle").cast("binary").alias("low"))
    return materialize(low.mapInArrow(run, ", ".join(f"{f} long" for f in fields)), "keyword-grams")


def _parts(table: DataFrame, by: str, row_bytes: Column) -> list[DataFrame]:
    """A written table in as many parts as its counted size asks for."""
    size = table.agg(F.sum(row_bytes)).first()[0] or 0
    n = -(-int(size) // PART_BYTES)
    if n == 1:
        return [table]
    return [table.filter(F.pmod(F.xxhash64(by, F.lit("part")), F.lit(n)) == i) for i in range(n)]


def _counts(low: DataFrame, wanted: DataFrame, kinds: list[int]) -> DataFrame:
    """`(gram, count)`: how often each wanted gram stands at the places that the texts give."""
    grams = np.sort(wanted.toArrow()["gram"].to_numpy().view(np.uint64))  # a part, so of bounded size
    shared = low.sparkSession.sparkContext.broadcast(grams)

    def run(batches):
        found = _Sorted(shared.value)
        counts = np.zeros(len(found.grams), dtype=np.int64)
        for b in _sliced(batches):
            codes, bounds = _joined([t or b"" for t in b["low"].to_pylist()])
            for i in kinds:
                for place, _ in _places(bounds, KINDS[i].gram, KINDS[i].stride):
                    # The places of a chunk, never all that a part may hold.
                    at, n = np.unique(found.find(_grams(codes, place, i))[1], return_counts=True)
                    counts[at] += n
        there = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.grams[there].view(np.int64)), pa.array(counts[there])], names=["gram", "count"])

    counted = low.select("low").mapInArrow(run, "gram long, count long")
    return counted.groupBy("gram").agg(F.sum("count").alias("count"))


def _rarest(grams: DataFrame, low: DataFrame, kinds: list[int]) -> DataFrame:
    """The least frequent gram of each keyword and residue; none where it is in no text."""
    wanted = _parts(materialize(grams.select("gram").distinct(), "grams"), "gram", F.lit(_ROW_BYTES))
    counts = materialize(reduce(DataFrame.unionAll, [_counts(low, part, kinds) for part in wanted]), "gram-counts")
    # A gram without a count is in no text, so nothing can be found by it.
    best = F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "offset", "gram")).alias("best")
    rarest = grams.join(counts, "gram", "left").groupBy("number", "residue").agg(best)
    return rarest.filter("best.count > 0").select("number", "best.offset", "best.gram")


class _Side(NamedTuple):
    """A part of the keyword side: grams in order with a keyword and the gram's place in it; the keywords."""

    grams: np.ndarray
    keyword: np.ndarray
    offset: np.ndarray
    number: np.ndarray
    codes: np.ndarray
    bounds: np.ndarray


def _side(part: DataFrame) -> _Side:
    rows = part.select("number", "offset", "gram", F.col("needle").cast("binary").alias("needle")).toArrow()
    number, first, keyword = np.unique(rows["number"].to_numpy(), return_index=True, return_inverse=True)
    codes, bounds = _joined(rows["needle"].take(pa.array(first)).to_pylist())
    grams = rows["gram"].to_numpy().view(np.uint64)
    order = np.argsort(grams, kind="stable")
    return _Side(grams[order], keyword[order], rows["offset"].to_numpy()[order], number, codes, bounds)


def _standing(side: _Side, codes: np.ndarray, start: np.ndarray, keyword: np.ndarray) -> np.ndarray:
    """Which of the pairs are a place and the keyword that stands there; all lie within their texts."""
    begin, length = side.bounds[keyword], side.bounds[keyword + 1] - side.bounds[keyword]
    left = np.arange(len(start))
    for j in range(_COLUMNS):
        k = np.minimum(j, length[left] - 1)
        left = left[codes[start[left] + k] == side.codes[begin[left] + k]]
    whole = [np.array_equal(codes[s:s + n], side.codes[b:b + n]) if n > _COLUMNS else True
             for s, b, n in zip(start[left].tolist(), begin[left].tolist(), length[left].tolist())]
    return left[np.array(whole, dtype=bool)]


def _found(side: _Side, index: _Sorted, codes: np.ndarray, bounds: np.ndarray, kinds: list[int]):
    """Text, keyword and start of every place where a keyword of the part stands, each once."""
    texts, keywords, starts = [], [], []
    for i in kinds:
        for place, text in _places(bounds, KINDS[i].gram, KINDS[i].stride):
            hit, first = index.find(_grams(codes, place, i))
            many = np.searchsorted(side.grams, side.grams[first], side="right") - first
            ends = np.cumsum(many)
            for at in range(0, int(ends[-1]) if len(ends) else 0, _CHUNK):
                pair = np.arange(at, min(at + _CHUNK, int(ends[-1])))
                of = np.searchsorted(ends, pair, side="right")
                row = first[of] + pair - (ends[of] - many[of])
                keyword, own = side.keyword[row], text[hit[of]]
                start = place[hit[of]] - side.offset[row]
                inside = (start >= bounds[own]) & (
                    start + side.bounds[keyword + 1] - side.bounds[keyword] <= bounds[own + 1])
                keyword, own, start = keyword[inside], own[inside], start[inside]
                there = _standing(side, codes, start, keyword)
                texts.append(own[there])
                keywords.append(keyword[there])
                starts.append(start[there])
    return [np.concatenate(x) if x else np.empty(0, np.int64) for x in (texts, keywords, starts)]


def _without_overlaps(starts: list[int], length: int) -> int:
    """How many of the ascending places are left, from the first on, when each takes `length`."""
    n, free = 0, -1
    for at in starts:
        if at >= free:
            n, free = n + 1, at + length
    return n


def _scores(side: _Side, text: np.ndarray, keyword: np.ndarray, start: np.ndarray):
    """Text, keyword and number of places without overlaps, a row for each text and keyword."""
    order = np.lexsort((start, keyword, text))
    text, keyword, start = text[order], keyword[order], start[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (keyword[1:] != keyword[:-1])
    first = np.flatnonzero(new)
    ends = np.append(first[1:], len(text))
    length = np.diff(side.bounds)
    close = np.zeros(len(text), dtype=bool)  # nearer to the one before than their length
    close[1:] = ~new[1:] & (start[1:] - start[:-1] < length[keyword[1:]])
    score = ends - first
    for i in np.flatnonzero(np.logical_or.reduceat(close, first)) if len(first) else []:
        score[i] = _without_overlaps(start[first[i]:ends[i]].tolist(), int(length[keyword[first[i]]]))
    return text[first], keyword[first], score


def _hits(low: DataFrame, part: DataFrame, kinds: list[int]) -> DataFrame:
    """`(id, number, score)` of the keywords of a part that stand in each text."""
    shared = low.sparkSession.sparkContext.broadcast(_side(part))
    schema = T.StructType([low.schema["id"], T.StructField("number", T.LongType()), T.StructField("score", T.LongType())])

    def run(batches):
        side = shared.value
        if not len(side.grams):
            return
        index = _Sorted(side.grams)
        for b in _sliced(batches):
            codes, bounds = _joined([t or b"" for t in b["low"].to_pylist()])
            text, keyword, score = _scores(side, *_found(side, index, codes, bounds, kinds))
            yield pa.RecordBatch.from_arrays(
                [b["id"].take(pa.array(text, pa.int64())), pa.array(side.number[keyword], pa.int64()),
                 pa.array(score, pa.int64())], names=["id", "number", "score"])

    return low.mapInArrow(run, schema)


def search_many(texts: DataFrame, id_col: str, text: Column, keywords: DataFrame) -> DataFrame:
    """The same rows as `candidates.search`, for a table `(pos, keyword)` of any length."""
    low = texts.select(F.col(id_col).alias("id"), F.lower(text).cast("binary").alias("low"))
    needles, kinds = _needles(keywords)
    found = []
    if kinds:
        grams = _rarest(_keyword_grams(needles), low, kinds)
        size = F.octet_length("keyword") + 5 * F.octet_length("needle") + _ROW_BYTES
        best = materialize(grams.join(needles, "number"), "rarest-grams")
        for part in _parts(best, "number", size):
            named = part.select("number", "pos", "keyword").distinct()
            found.append(_hits(low, part, kinds).join(F.broadcast(named), "number"))
    if not found:
        types = dict(needles.dtypes) | dict(low.dtypes)
        names = {"pos": types["pos"], "keyword": "string", "id": types["id"], "score": "bigint"}
        return texts.sparkSession.createDataFrame([], ", ".join(f"{n} {t}" for n, t in names.items()))
    return reduce(DataFrame.unionAll, found).select("pos", "keyword", "id", "score")
