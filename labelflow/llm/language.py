"""Language ID by rank-order profiles and the out-of-place distance.

A profile lists the most frequent letter n-grams (n = 1 to 3, with word borders) of a language in
order. A document's own list is compared with each profile: an n-gram costs the difference of its
two ranks, one that the profile lacks costs the whole profile length. The nearest profile wins;
equal distances go to the smaller language name, equal counts to the smaller n-gram.

Counts for the profiles cover every learning row. Texts that are null or have no letter get `und`
and score 0; so do all texts when nothing could be learned.
"""

from functools import lru_cache
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelflow.llm.common import CHUNK_CHARS, fold, map_batches, release, texts_of
from labelflow.scale import materialize

TOP = 400  # n-grams of a profile and of a document's list
MAX_LANGUAGES = 1000  # profiles go to every task; more label values than this are an error
HELD_CHARS = 1 << 18  # of a language, whose n-grams are held before they are counted
BATCH_BYTES = 4 << 20  # of an Arrow batch that become Python objects at once
FAR_OUT = 3.0  # spreads below the lower quartile at which a labelled row no longer tells its language
LEAST_SPREAD = 0.1  # of scores between the quartiles, so that many copies do not narrow the border
SHORT = 100  # characters; the few n-grams of a shorter text tell no far-off one, so its label stands
STEPS = 1000  # of the scores, for the quartiles
BROADCAST_ROWS = 200_000  # rows of 16 bytes that may go to every task; more are joined by shuffle
UNKNOWN = "und"
OUTPUT = "doc_id long, held_out boolean, lang_pred string, score double"

_BITS = 21  # of a code point


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def letter_codes(text: str) -> np.ndarray:
    """Lower-cased code points with one 0 for each run of anything but letters, 0 at both ends."""
    raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.where(_letters()[raw], raw, 0).astype(np.int64)
    codes = np.concatenate(([0], codes, [0]))
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    return codes[keep]


def gram_counts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams and their counts, over the whole array in bounded pieces."""
    if len(codes) <= CHUNK_CHARS:
        return np.unique(_pieces(codes, 0), return_counts=True)
    keys, counts = [], []
    for at in range(0, len(codes), CHUNK_CHARS):
        k, c = np.unique(_pieces(codes, at), return_counts=True)
        keys.append(k)
        counts.append(c)
    return merge_counts(keys, counts)


def _pieces(codes: np.ndarray, at: int) -> np.ndarray:
    """N-grams of 1 to 3 code points that start in `[at, at + CHUNK_CHARS)`, as numbers.

    A border is only the first or last of an n-gram. A tag bit keeps pairs apart from triples that
    begin with a border.
    """
    end = at + CHUNK_CHARS
    one = codes[at:end]
    one = one[one > 0]
    a, b = codes[at:end], codes[at + 1:end + 1]
    a = a[:len(b)]
    two = (a << _BITS) | b | (1 << 2 * _BITS) | (np.int64(1) << 62)
    c = codes[at + 2:end + 2]
    a, b = a[:len(c)], b[:len(c)]
    three = (a << 2 * _BITS) | (b << _BITS) | c
    return np.concatenate((one, two, three[b > 0]))


def merge_counts(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    all_keys, all_counts = np.concatenate(keys), np.concatenate(counts)
    distinct, inverse = np.unique(all_keys, return_inverse=True)
    return distinct, np.bincount(inverse, weights=all_counts, minlength=len(distinct)).astype(np.int64)


def ranked(keys: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The `top` most frequent n-grams, in order."""
    if len(keys) > 4 * top:  # all that may be among them, before the sort
        least = np.partition(counts, len(counts) - top)[len(counts) - top]
        some = counts >= least
        keys, counts = keys[some], counts[some]
    return keys[np.lexsort((keys, -counts))[:top]]


def learn_profiles(docs: DataFrame, top: int = TOP, key: str = "doc_id", text: str = "text",
                   label: str = "lang") -> dict[str, list[int]]:
    """Profile of each label over all rows that have one: at most `top` n-grams a label.

    Counting happens in the tasks, sums by (label, n-gram); each task then sends at most `top`
    n-grams of a label to the final ranking.
    """
    rows = docs.filter(F.col(label).isNotNull()).select(
        F.col(label).cast("string").alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )

    def run(batches):
        held: dict[str, list] = {}
        size: dict[str, int] = {}
        out: dict[str, tuple] = {}

        def close(lang):
            k, c = np.unique(np.concatenate(held.pop(lang)), return_counts=True)
            size[lang] = 0
            old = out.get(lang)
            out[lang] = (k, c) if old is None else merge_counts([old[0], k], [old[1], c])

        def counted():
            for lang in list(held):
                close(lang)
            for lang, (k, c) in out.items():
                yield {"lang": [lang] * len(k), "gram": k, "n": c}
            out.clear()

        for b in batches:
            for lang, t in zip(b["lang"], b["text"]):
                codes = letter_codes(t)
                for at in range(0, len(codes), CHUNK_CHARS):
                    held.setdefault(lang, []).append(_pieces(codes, at))
                    size[lang] = size.get(lang, 0) + min(CHUNK_CHARS, len(codes) - at)
                    if size[lang] >= HELD_CHARS:
                        close(lang)
            if sum(size.values()) + sum(len(k) for k, _ in out.values()) > CHUNK_CHARS:
                yield from counted()
        yield from counted()

    counted = map_batches(rows, run, "lang string, gram long, n long", BATCH_BYTES).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = W.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = counted.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= top)
    got = best.take(MAX_LANGUAGES * top + 1)
    profiles: dict[str, list] = {}
    for row in got:
        profiles.setdefault(row.lang, []).append((row.r, row.gram))
    if len(profiles) > MAX_LANGUAGES or len(got) > MAX_LANGUAGES * top:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return {lang: [g for _, g in sorted(rows)] for lang, rows in profiles.items()}


class Profiles:
    """All profiles as one table: n-gram -> rank in each language, `top` where it is absent."""

    def __init__(self, profiles: dict[str, list[int]], top: int = TOP):
        self.top = top
        self.languages = sorted(profiles)
        self.grams = np.array(sorted({g for p in profiles.values() for g in p}), dtype=np.int64)
        self.rank = np.full((len(self.grams) + 1, len(self.languages)), top, dtype=np.int64)
        for j, lang in enumerate(self.languages):
            at = np.searchsorted(self.grams, np.array(profiles[lang], dtype=np.int64))
            self.rank[at, j] = np.arange(len(profiles[lang]))

    def predict(self, text: str) -> tuple[str, float]:
        codes = letter_codes(text) if text else np.zeros(1, np.int64)
        if not self.languages or not codes.any():
            return UNKNOWN, 0.0
        mine = ranked(*gram_counts(codes), self.top)
        at = np.minimum(np.searchsorted(self.grams, mine), max(len(self.grams) - 1, 0))
        at = np.where(self.grams[at] == mine, at, len(self.grams)) if len(self.grams) else at
        theirs = self.rank[at]
        own = np.arange(len(mine))[:, None]
        distance = np.where(theirs == self.top, self.top, np.abs(theirs - own)).sum(axis=0)
        best = int(distance.argmin())
        return self.languages[best], 1.0 - float(distance[best]) / (self.top * len(mine))


def language_column(profiles: dict[str, list[int]], text: Column, top: int = TOP) -> Column:
    """Struct `(lang, score)` of a text; a null one counts as empty. Only the text goes to Python.

    The column is marked nondeterministic, so a filter on it doesn't compute it again.
    """
    kind = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = Profiles(profiles, top)
        try:
            for texts in batches:
                got = [table.predict(t.as_py()) for t in texts]
                yield pa.StructArray.from_arrays(
                    [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                    names=["lang", "score"])
        finally:
            texts = got = None
            release()

    return F.arrow_udf(run, kind).asNondeterministic()(F.coalesce(text, F.lit("")))


def fresh(taken: list[str], name: str) -> str:
    """`name`, with underscores until no column has it; names differ by more than case."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def predict_languages(docs: DataFrame, profiles: dict[str, list[int]], top: int = TOP, text: str = "text",
                      names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Every row with its columns and the two of `names`; older columns of these names go."""
    kept = docs.drop(*names)
    found = fresh([*kept.columns, *names], "found")
    return kept.withColumn(found, language_column(profiles, kept[text], top)).select(
        *[F.col(f"`{c.replace('`', '``')}`") for c in kept.columns],
        F.col(found)["lang"].alias(names[0]), F.col(found)["score"].alias(names[1]))


def far_out(steps: dict[int, int]) -> float:
    """The score below which a labelled row is far from the others, by the number of rows at each step."""
    at = np.array(sorted(steps))
    ends = np.cumsum([steps[i] for i in at.tolist()])
    low, high = (at[np.searchsorted(ends, share * ends[-1])] / STEPS for share in (0.25, 0.75))
    return float(low - FAR_OUT * max(high - low, LEAST_SPREAD))


def with_known_language(docs: DataFrame, top: int = TOP, text: str = "text", label: str = "lang") -> DataFrame:
    """The rows of `docs` in a language that their labels tell, columns unchanged.

    Profiles come from the labelled rows. A row goes, labelled or not, if its text has no letter, or if
    it is further from its nearest profile than the rows that are labelled so: their least score is the
    border. Labelled rows that are nearest to another language, or whose score is far out (`FAR_OUT`
    spreads below the lower quartile), are noise or mislabelled and set no border. A language to which
    no row of its label is nearest has none. Texts below `SHORT` that are nearest to their label stay. Without any labelled text all texts with a letter stay.
    """
    profiles = learn_profiles(docs, top, text=text, label=label)
    if not profiles:
        return docs.filter(F.coalesce(docs[text].rlike(r"\p{L}"), F.lit(False)))
    # Written without the texts, which two hashes stand for: text and label tell whether a row stays.
    own_label = docs[label].cast("string")
    h, g = _hashes(docs[text], own_label)
    written = docs.select(
        h.alias("h"), g.alias("g"), own_label.alias("label"), (F.length(docs[text]) < SHORT).alias("short"),
        language_column(profiles, docs[text], top).alias("found"))
    predicted = materialize(written.select("h", "g", "label", "short", "found.lang", "found.score"), "predicted")
    lang, score = F.col("lang"), F.col("score")
    own = predicted.filter((F.col("label") == lang) & (lang != UNKNOWN))
    at = F.floor(score * STEPS).cast("int")
    steps: dict[str, dict[int, int]] = {}
    for name, step, n in own.groupBy(lang, at).agg(F.count(F.lit(1))).collect():  # at most STEPS + 1 a language
        steps.setdefault(name, {})[step] = n

    def per_language(values: dict[str, float]) -> Column:
        value = F.lit(0.0)
        for name, one in values.items():
            value = F.when(lang == name, F.lit(one)).otherwise(value)
        return value

    near = own.filter(score >= per_language({name: far_out(of) for name, of in steps.items()}))
    borders = {r[0]: r[1] for r in near.groupBy(lang).agg(F.min(score)).collect()}  # a row a language
    short = F.coalesce("short", F.lit(False)) & F.col("label").eqNullSafe(lang)
    stays = (lang != UNKNOWN) & ((score >= per_language(borders)) | short)
    gone = materialize(predicted.filter(~stays).select(F.col("h").alias("_h"), F.col("g").alias("_g")).distinct(), "gone")
    if gone.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return docs.join(gone, (gone["_h"] == h) & (gone["_g"] == g), "left_anti")


def _hashes(text: Column, label: Column) -> tuple[Column, Column]:
    """Hash of a text, and of its label and it; a null text counts as an empty one."""
    whole = F.coalesce(text, F.lit(""))
    return F.xxhash64(whole), F.xxhash64(label.isNull(), label, whole)


def identify(docs: DataFrame, top: int = TOP, held_out_fold: int = 0, key: str = "doc_id",
             text: str = "text", label: str = "lang") -> DataFrame:
    """Learn from rows outside the held-out fold, predict all rows: `OUTPUT`."""
    learned = learn_profiles(docs.filter(fold(key) != held_out_fold), top, key, text, label)
    plain = texts_of(docs, key, text).withColumn("held_out", fold("doc_id") == held_out_fold)
    found = language_column(learned, F.col("text"), top)
    return plain.select("doc_id", "held_out", found.alias("found")).select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")
