"""Spelling variant grouping by dense prefix-suffix tiling.

Words are runs of letters, A-Z lower-cased, that occur often enough. Two words are near if they
differ by exactly one inserted, deleted or replaced code point: with `m` the length of the longer
one, common prefix plus common suffix must reach `m - 1`. A word's form is its most frequent near
word, if that is at least `RATIO` times as frequent as the word; its root is where the forms end.

Blocks. A pair with a common prefix of `p < m` code points falls into one of `PANELS` panels of the
places 0..m-1, say [a, b). Then the first `a` code points agree, and the last `m - b` do too. So a word
of length L enters, for m = L and m = L + 1 and each panel, the block of its first `a` and last `m - b`
code points, and each near pair meets in exactly one block: the one of its panel. A block is a
matrix of code points, padded to `m` columns; dense comparisons of all its rows give every pair's
common prefix and suffix. A block of more than `TILE_CODES / m` rows (at most `TILE_ROWS`) is dealt to
groups by a hash, and each pair of groups is a tile of its own, so a very common beginning is
spread over tasks; the rows sent for it are its size times its number of groups. No pairs leave a
tile: each row gets its number of near words and the best of them, added up per word afterwards.

Chains of forms are short, as each step multiplies the count by `RATIO`; they are followed by
doubling. The words that point to one form differ from it by one edit, so they are a bounded group.

A null text has no words; a null id counts as an empty text in the hash; repeated rows count
each; ties go to the smaller word in code-point order; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelflow.llm.common import ASCII_LOWER, arrow_type, map_batches
from labelflow.scale import dimension, materialize

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
DAMAGE = 199  # the query's own noise: a run loses a code point where this divides its hash
PANELS = 3
TILE_ROWS, TILE_CODES = 512, 1 << 19
STACK_PAIRS = 1 << 18  # pairs compared at once, of tiles of one shape
HELD_WORDS = 200_000  # distinct words that a task counts before it hands them on
LONG_TEXT = 1 << 20  # characters from which the runs of a text are not listed at once
OUTPUT = ("word", "form", "root", "n", "n_near", "form_n")


# Words ------------------------------------------------------------------------------------------


def lower_ascii(word: str) -> str:
    return word.lower() if word.isascii() else word.translate(ASCII_LOWER)


def damaged(doc: str, word: str, modulus: int) -> str:
    """The word, without one code point if `modulus` divides the hash of document and word."""
    h = zlib.crc32(f"{doc}:{word}".encode())
    if h % modulus:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", damage: int | None = None,
                min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """`(word, n)` of all rows, counted in the tasks first; shorter and rarer words go."""
    rows = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("doc"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )

    def run(batches):
        counts: Counter[str] = Counter()

        def out():
            return {"word": list(counts), "n": list(counts.values())}

        for b in batches:
            for doc, t in zip(b["doc"], b["text"]):
                runs = LETTERS.findall(t) if len(t) < LONG_TEXT else (m.group() for m in LETTERS.finditer(t))
                for w, n in Counter(runs).items():
                    if len(w) >= min_length:
                        w = lower_ascii(w)
                        if damage is not None:
                            w = damaged(doc, w, damage)
                        counts[w] += n
                if len(counts) > HELD_WORDS:
                    yield out()
                    counts.clear()
        yield out()

    counted = map_batches(rows, run, "word string, n long")
    long_enough = counted.filter(F.length("word") >= min_length)
    return long_enough.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


# Blocks -----------------------------------------------------------------------------------------


def _memberships(word: Column, length: Column, panels: int) -> Column:
    """Array of `(m, panel, low, high, block)` for one word."""
    out = []
    for longer in (0, 1):
        m = length + longer
        for i in range(panels):
            low, high = F.floor(m * i / panels).cast("int"), F.floor(m * (i + 1) / panels).cast("int")
            block = F.xxhash64(F.substring(word, F.lit(1), low), F.when(high < m, F.right(word, m - high)).otherwise(""))
            out.append(F.struct(
                m.cast("int").alias("m"), F.lit(i).alias("panel"), low.alias("low"), high.alias("high"),
                block.alias("block")))
    # A panel without places belongs to words shorter than the number of panels.
    return F.filter(F.array(*out), lambda x: x["low"] < x["high"])


def tiles(words: DataFrame, panels: int = PANELS) -> DataFrame:
    """Rows of all tiles: `(m, panel, block, left, right, side, low, high, word, n)`.

    `side` is 0 for rows of the left group, 1 for rows of the right one; where both are the same
    group, all rows have side 0.
    """
    members = words.select("word", "n", F.explode(_memberships(F.col("word"), F.length("word"), panels)).alias("x"))
    members = members.select("word", "n", "x.*")
    rows_of_tile = F.greatest(F.lit(1), F.least(F.lit(TILE_ROWS), F.floor(F.lit(TILE_CODES) / F.col("m"))))
    sizes = members.groupBy("m", "panel", "block").agg(F.count(F.lit(1)).alias("rows"))
    large = sizes.select(
        "m", "panel", "block", F.ceil(F.col("rows") / rows_of_tile).cast("int").alias("groups")
    ).filter("groups > 1")
    placed = members.join(dimension(large, name="large-blocks"), ["m", "panel", "block"], "left").withColumn(
        "groups", F.coalesce("groups", F.lit(1)))
    placed = placed.withColumn("mine", F.pmod(F.xxhash64("word"), F.col("groups")).cast("int"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    return dealt.select(
        "m", "panel", "block", F.least("mine", "other").alias("left"), F.greatest("mine", "other").alias("right"),
        (F.col("mine") > F.col("other")).cast("int").alias("side"), "low", "high", "word", "n",
    )


def code_points(words: np.ndarray, width: int) -> np.ndarray:
    """The code points of an array of words in a new last axis, padded with 0 at the end."""
    codes = words.astype(f"U{width}").view(np.uint32).reshape(*words.shape, width)
    return codes.astype(np.uint8) if codes.max() < 256 else codes


def near_in_tiles(left: np.ndarray, left_sizes: np.ndarray, right: np.ndarray, right_sizes: np.ndarray,
                  low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For a stack of tiles: which pairs differ by one edit and have a common prefix in [low, high).

    `left` is (tiles, rows, m), `right` (tiles, other rows, m); all rows of a tile are distinct words
    of `m` or `m - 1` code points. Returns (tiles, rows, other rows).
    """
    m = left.shape[2]
    shorter = np.minimum(left_sizes[:, :, None], right_sizes[:, None, :])
    prefix = _common(left, right, shorter)
    suffix = _common(_from_the_end(left, left_sizes), _from_the_end(right, right_sizes), shorter)
    longer = np.maximum(left_sizes[:, :, None], right_sizes[:, None, :])
    in_panel = (prefix >= low[:, None, None]) & (prefix < high[:, None, None])
    return (longer == m) & (prefix + suffix >= m - 1) & in_panel


def _common(left: np.ndarray, right: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """How many code points all pairs of rows have in common from the start, column by column."""
    number = np.zeros(shorter.shape, dtype=np.int32)
    same = np.ones(shorter.shape, dtype=bool)
    for j in range(left.shape[2]):
        same &= left[:, :, None, j] == right[:, None, :, j]
        if not same.any():
            break
        number += same
    # Padding equals padding, but nothing is common past the end of the shorter word.
    return np.minimum(number, shorter)


def _from_the_end(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The rows reversed, each from its own last code point, padded at the end."""
    at = sizes[..., None] - 1 - np.arange(codes.shape[2])
    return np.where(at >= 0, np.take_along_axis(codes, np.maximum(at, 0), axis=2), 0)


_TILE = ("m", "panel", "block", "left", "right")
_NEAR = "word string, n_near long, best_n long, best string"


def _near_of_task(batches, schema: pa.Schema):
    """Near words of each tile.

    The rows of a tile are neighbours, frequent words first; a tile fits in memory.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch])
        starts = _starts(table)
        last = int(starts[-1])
        if last:
            yield from _near_rows(table.slice(0, last), starts[:-1], schema)
        held = table.slice(last).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield from _near_rows(table, _starts(table), schema)


def _starts(table: pa.Table) -> np.ndarray:
    """Places at which a tile begins."""
    new = np.zeros(table.num_rows, dtype=bool)
    new[0] = True
    for name in _TILE:
        values = table.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _near_rows(table: pa.Table, starts: np.ndarray, schema: pa.Schema):
    """Tiles of one shape are stacked and compared together."""
    words = np.array(table.column("word").to_pylist(), dtype=object)
    sizes = np.array([len(w) for w in words], dtype=np.int32)
    counts, side, m, low, high, one, other = (
        table.column(c).to_numpy() for c in ("n", "side", "m", "low", "high", "left", "right"))
    shapes: dict[tuple, list] = {}
    for start, end in zip(starts, np.append(starts[1:], table.num_rows)):
        rows = np.arange(start, end)
        alone = one[start] == other[start]
        left, right = (rows, rows) if alone else (rows[side[start:end] == 0], rows[side[start:end] == 1])
        if len(left) and len(right) and not (alone and len(rows) == 1):
            shapes.setdefault((m[start], len(left), len(right), alone), []).append((left, right))
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for (width, a, b, alone), stack in shapes.items():
        step = max(1, min(STACK_PAIRS // (a * b), TILE_CODES // (max(a, b) * width)))
        for i in range(0, len(stack), step):
            left, right = (np.array(x) for x in zip(*stack[i:i + step]))
            codes = code_points(words[left], width)
            others = codes if alone else code_points(words[right], width)
            near = near_in_tiles(codes, sizes[left], others, sizes[right], low[left[:, 0]], high[left[:, 0]])
            out += _best(near, left, right)
            if not alone:
                out += _best(near.transpose(0, 2, 1), right, left)
    if out:
        word, number, best = (np.concatenate(x) for x in zip(*out))
        yield pa.RecordBatch.from_arrays([
            pa.array(words[word], pa.string()), pa.array(number, pa.int64()),
            pa.array(counts[best], pa.int64()), pa.array(words[best], pa.string())], schema=schema)


def _best(near: np.ndarray, rows: np.ndarray, others: np.ndarray):
    """For the rows with near words: row, number of near words, the first of them."""
    number = near.sum(axis=2)
    tile, place = np.nonzero(number)
    if not len(tile):
        return []
    return [(rows[tile, place], number[tile, place], others[tile, near[tile, place].argmax(axis=1)])]


def near_words(words: DataFrame, panels: int = PANELS) -> DataFrame:
    """`(word, n_near, best_n, best)` for the words that have a near one."""
    dealt = tiles(words, panels)
    in_order = dealt.repartition(*_TILE).sortWithinPartitions(*_TILE, F.desc("n"), "word")
    schema = arrow_type(_NEAR)  # parsed by the driver's session
    found = in_order.mapInArrow(lambda batches: _near_of_task(batches, schema), _NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("best")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.minus")).alias("best_n"), F.col("b.best").alias("best"))


# Forms ------------------------------------------------------------------------------------------


def with_roots(forms: DataFrame) -> DataFrame:
    """`(word, root)` for the words of `(word, form)`: the last form of each chain, by doubling."""
    step = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        after = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(step.join(after, "root", "left").select("word", "root", "next"), "roots")
        if moved.filter("next IS NOT NULL").isEmpty():
            return moved.select("word", "root")
        step = materialize(moved.select("word", F.coalesce("next", "root").alias("root")), "roots")


def group_variants(words: DataFrame, ratio: int = RATIO, panels: int = PANELS) -> DataFrame:
    """One row per word of `(word, n)`, as `OUTPUT`."""
    words = materialize(words.select("word", "n"), "words")
    joined = words.join(near_words(words, panels), "word", "left")
    form = F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best"))
    formed = materialize(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), form.alias("form"),
        F.when(form.isNotNull(), F.col("best_n")).alias("form_n"),
    ), "forms")
    roots = with_roots(formed.filter("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, damage: int | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Words of all texts of `docs` with their forms and roots."""
    return group_variants(count_words(docs, key, text, damage))
