"""Join of documents whose sets of five-word shingles have a Jaccard similarity of 0.75 or more.

The size-aware, heavy-light method. All shingles have one global order, the rare ones first. Two
similar sets share an element among the first `n - ceil(0.75 n) + 1` of each, and two of the first
`n - ceil(0.75 n) + 2`. So light (small) sets enumerate the pairs of the latter as keys, which hardly
ever meet by chance; heavy (large) sets, and light ones near the border, list the former, and the
inverted lists are scanned. The border is the size at which the estimated cost of both is least.

* Order: shingles are counted in a fixed number of bins in the tasks, and the bins are summed. Any
  order that all documents share gives whole results; the counts only put frequent ones last.
* Copies: equal sets are one entry (a hash of the set and its size), whatever their number.
* Places: a pair is a candidate only where the places of a common key leave enough elements behind
  it in both sets; the first common key of similar sets always does.
* Lists: the entries of a key are compared with up to four of them, its centres, and linked to
  those that are similar. Long lists are dealt to parts with centres of their own, and one centre of
  each part is compared with one of the key's. Entries that are in one component by now need no comparison; of every list that
  still holds several components, the entries outside its largest one are compared with all of
  other components. A whole list is written without its centres, which are compared with all its
  entries, and only where two entries are left. So every pair that shares a key is compared, or already connected, and no list
  of copies or near copies is expanded to pairs.
* Every comparison is exact, on whole sets; bits of their elements' places, two or more an element,
  first tell pairs that cannot be similar, whatever the rest.

A document without words has no shingle, links with nothing, and is its own component. Repeated
rows give repeated results. A null id takes part; the component is the smallest id that is there.
Shingles are 64-bit hashes.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelflow.llm.common import map_batches, texts_of
from labelflow.llm.graph import components
from labelflow.scale import materialize

SHINGLE = 5
SHARE = (75, 100)  # similarity as a fraction
BINS = 1 << 18  # of the counts that order the shingles; the table goes to every task
MAX_BORDER = 32  # the border is looked for among sizes up to this one
PART = 4096  # a key's list is dealt to one part for each so many rows above the usual
MAX_PARTS = 1 << 22  # parts of a list; their number stands above the key's bits
KEY_BITS = 40  # keys that meet by chance cost a comparison; fewer bits are less to shuffle
SKETCH_BITS = 1 << 12  # of a sketch at least; a power of two
MARKS = 1 << 22  # bits of the filter on entries that were candidates
BROADCAST_ROWS = 200_000  # rows of 16 bytes that may go to every task; more are joined by shuffle
BLOCK_ROWS = 1 << 18  # rows of keys that a task holds before it packs them
SLOT_ROWS = 150_000  # rows of keys that one task sorts
OUT_ROWS = 20_000  # rows handed on at once
MOST_SEEN = 1 << 20  # entries that a task remembers
BATCH_BYTES = 4 << 20  # of an Arrow batch that become Python objects at once
BLOCK = 1 << 19  # bytes that are hashed at once; a longer text is cut at white space
OUTPUT = "doc_id long, n_shingles long, component_id long"

_P1, _P2 = np.uint64(0x9E3779B185EBCA87), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _P2
    x = (x ^ (x >> np.uint64(29))) * _P1
    return x ^ (x >> np.uint64(32))


_STEPS = np.array([0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63,
                   0x27D4EB2F165667C5], dtype=np.uint64)


_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
with np.errstate(over="ignore"):
    # A number for each byte; the hash of a word is their polynomial in an odd base.
    _BYTES = np.where(_IS_SPACE, np.uint64(0), _mix(np.arange(1, 257, dtype=np.uint64) * _P1))
_BASE = 0x9FB21C651E98DF25


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, as many as were asked for."""

    up = down = np.ones(0, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (
                np.cumprod(np.array([1, *([base] * (n - 1))], dtype=np.uint64), dtype=np.uint64)
                for base in (_BASE, pow(_BASE, -1, 1 << 64)))
        return self.up[:n], self.down


_POWERS = _Powers()


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts, and its hash; `data` ends with white space."""
    octets = np.frombuffer(data, dtype=np.uint8)
    edges = np.flatnonzero(np.diff(_IS_SPACE[octets], prepend=True))
    starts, ends = edges[::2], edges[1::2]
    up, down = _POWERS.of(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[octets] * up, out=sums[1:])
    return starts, _mix((sums[ends] - sums[starts]) * down[starts])


def _blocks(data: bytes):
    """`data` in blocks that end with white space."""
    at = 0
    while len(data) - at > BLOCK:
        cut = _SPACE.search(data, at + BLOCK - 1)
        if cut is None:
            break
        yield data[at:cut.end()]
        at = cut.end()
    yield data[at:]


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit numbers."""
    # Bytes: lower() then changes A-Z only; words are cut at the six ASCII white-space characters.
    coded = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
    begins = np.cumsum([0] + [len(t) + 1 for t in coded])
    with np.errstate(over="ignore"):
        at, starts, hashes = 0, [], []
        for block in _blocks(b"".join(t + b" " for t in coded)):
            found, values = _word_hashes(block)
            starts.append(found + at)
            hashes.append(values)
            at += len(block)
        hashes = np.concatenate(hashes)
        lengths = np.diff(np.searchsorted(np.concatenate(starts), begins)).tolist()
        whole = np.zeros(max(0, len(hashes) - SHINGLE + 1), dtype=np.uint64)
        for i, step in enumerate(_STEPS):
            whole += hashes[i:i + len(whole)] * step
        whole = _mix(whole)
        out, at = [], 0
        for n in lengths:
            if n >= SHINGLE:
                some = np.sort(whole[at:at + n - SHINGLE + 1])
                changes = some[1:] != some[:-1]
                out.append(some if changes.all() else np.append(some[:1], some[1:][changes]))
            else:  # the whole sequence as one, told apart by its length
                some = (hashes[at:at + n] * _STEPS[:n]).sum(dtype=np.uint64, keepdims=True) if n else hashes[:0]
                out.append(_mix(some + np.uint64(n)))
            at += n
    return out


def _pieces(texts: list[str]):
    """The texts in groups of some 100,000 characters."""
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size > 100_000:
            yield group
            group, size = [], 0
    if group:
        yield group


def entry_of(shingles: np.ndarray) -> int:
    """A 64-bit name of a set."""
    from xxhash import xxh64_intdigest

    return int(np.array([xxh64_intdigest(shingles.tobytes(), seed=len(shingles))], dtype=np.uint64).view(np.int64)[0])


def sketch_of(shingles: np.ndarray) -> bytes:
    """Bits of the places that the elements of a set fall on, at least two places an element."""
    bits = max(SKETCH_BITS, 1 << (2 * len(shingles) - 1).bit_length()) if len(shingles) else SKETCH_BITS
    places = np.zeros(bits, dtype=bool)
    places[shingles % np.uint64(bits)] = True
    return np.packbits(places).tobytes()


def _folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """The same set's sketch in `size` numbers."""
    while len(sketch) > size:
        sketch = sketch[:len(sketch) // 2] | sketch[len(sketch) // 2:]
    return sketch


def most_common(x: bytes, y: bytes, n: int, m: int) -> int:
    """Elements that sets of n and m with these sketches share at most: each place that only one of
    them has stands for an element that the other lacks."""
    p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    size = min(len(p), len(q))
    p, q = _folded(p, size), _folded(q, size)
    return min(n - int(np.bitwise_count(p & ~q).sum()), m - int(np.bitwise_count(q & ~p).sum()))


def _bin(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(40)).astype(np.int64) % BINS


def prefix(n: int, shared: int) -> int:
    """First elements of a set of n among which a similar set shares at least `shared`."""
    least = -(-SHARE[0] * n // SHARE[1])
    return min(n, n - least + shared)


def similar(common: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return SHARE[1] * common >= SHARE[0] * (n + m - common)


def border(sizes: list[tuple[int, int]], list_length: float) -> int:
    """Sets below it are light. `sizes`: number of sets of each size; a scanned row costs as much as
    an enumerated one, and each listed element meets `list_length` others."""
    best, chosen = None, 1
    for x in range(1, MAX_BORDER + 1):
        cost = 0.0
        for n, count in sizes:
            if n < x:
                p = prefix(n, 2)
                cost += count * p * (p - 1) / 2
            if SHARE[1] * n >= SHARE[0] * x:
                cost += count * prefix(n, 1) * (1.0 + list_length)
        if best is None or cost < best:
            best, chosen = cost, x
    return chosen


def _number_of_keys(rows: DataFrame, light_below: int) -> int:
    """Keys of all rows, copies included."""
    n = F.col("n_shingles")

    def first(shared: int) -> Column:
        return F.least(n, n - F.ceil(n * SHARE[0] / SHARE[1]) + shared)

    light = F.when(n < light_below, first(2) * (first(2) - 1) / 2).otherwise(0)
    heavy = F.when(SHARE[1] * n >= SHARE[0] * light_below, first(1)).otherwise(0)
    return int(rows.filter(n > 0).agg(F.sum(light + heavy)).first()[0] or 0)


class Keys:
    """Keys of a set under the global order."""

    def __init__(self, counts: np.ndarray, light_below: int):
        self.counts, self.light_below = counts, light_below
        self.usual = 2 * float(counts.mean()) if len(counts) else 0.0

    def of(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys, the number of parts that the list of each is dealt to, and how many elements a set
        can share at most with one whose first common key it is."""
        n = len(shingles)
        count = self.counts[_bin(shingles)]
        first = np.argsort(count, kind="stable")[:prefix(n, 2)]  # the shingles are sorted
        ordered, count = shingles[first], count[first]
        keys, often, rest = [], [], []
        with np.errstate(over="ignore"):
            if n < self.light_below and len(ordered) >= 2:
                i, j = np.triu_indices(len(ordered), 1)
                keys.append(_mix(_mix(ordered[i] + _P2) * _P1 + ordered[j]))
                often.append(np.minimum(count[i], count[j]))
                rest.append(n - j + 1)
        if SHARE[1] * n >= SHARE[0] * self.light_below:
            p = prefix(n, 1)
            keys.append(ordered[:p])
            often.append(count[:p])
            rest.append(n - np.arange(p))
        if not keys:
            return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        extra = np.maximum(0, np.concatenate(often) - self.usual)
        return np.concatenate(keys), 1 + (extra // PART).astype(np.int64), np.concatenate(rest)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _facts(texts: DataFrame) -> DataFrame:
    """One written table of two kinds of rows: `(doc_id, n, entry, h)` of each text with `entry` null for
    texts without words, and `(bin, shingles in it)` of each task."""
    def run(batches):
        bins = np.zeros(BINS, dtype=np.int64)
        for b in batches:
            sizes, entries = [], []
            for group in _pieces(b["text"]):
                sets = shingle_sets(group)
                bins += np.bincount(_bin(np.concatenate(sets)), minlength=BINS)
                sizes += [len(s) for s in sets]
                entries += [entry_of(s) if len(s) else None for s in sets]
            yield {"counts": [False] * len(sizes), "id": b["doc_id"], "n": sizes, "entry": entries, "h": b["h"]}
        used = np.flatnonzero(bins)
        empty = [None] * len(used)
        yield {"counts": [True] * len(used), "id": used, "n": bins[used], "entry": empty, "h": empty}

    hashed = texts.withColumn("h", F.xxhash64("text"))
    schema = "counts boolean, id long, n long, entry long, h long"
    return materialize(map_batches(hashed, run, schema, BATCH_BYTES), "shingle-facts")


def _bin_counts(facts: DataFrame) -> np.ndarray:
    got = facts.filter("counts").groupBy("id").agg(F.sum("n").alias("n")).toArrow()  # at most BINS rows
    counts = np.zeros(BINS, dtype=np.int64)
    counts[got.column("id").to_numpy()] = got.column("n").to_numpy()
    return counts


def _narrow(x: np.ndarray) -> np.ndarray:
    """The same numbers, none negative, in as few bytes each as hold them."""
    most = int(x.max(initial=0))
    return x.astype(np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.uint64)


_WIDTHS = {2: np.uint16, 4: np.uint32, 8: np.uint64}
_HEAD = struct.Struct("<qi4B")  # first place, rows, bytes of each column's numbers


def _pack(place: np.ndarray, entry: np.ndarray, n: np.ndarray, rest: np.ndarray) -> bytes:
    """Rows in the order of their place as one block: differences of the places, then the other columns."""
    steps = np.diff(place.view(np.uint64), prepend=place.view(np.uint64)[:1])
    columns = [_narrow(steps), entry, _narrow(n), _narrow(rest)]
    return b"".join([_HEAD.pack(place[0], len(place), *(c.itemsize for c in columns)), *(c.tobytes() for c in columns)])


def _unpack(block: bytes) -> list[np.ndarray]:
    first, rows, *widths = _HEAD.unpack_from(block)
    columns, at = [], _HEAD.size
    for i, width in enumerate(widths):
        kind = np.int64 if i == 1 else _WIDTHS[width]
        columns.append(np.frombuffer(block, kind, rows, at))
        at += rows * width
    steps = columns[0].astype(np.uint64)
    columns[0] = (np.cumsum(steps, dtype=np.uint64) + np.array([first]).view(np.uint64)).view(np.int64)
    return [c if c.dtype == np.int64 else c.astype(np.int64) for c in columns]


def _key_blocks(texts: DataFrame, counts: np.ndarray, light_below: int, slots: int) -> DataFrame:
    """`(slot, block)`: the keys of all sets, those of equal sets once a task; all rows of a place (part
    of a key's list) go to one slot. The sign of a place tells lists that are dealt to parts; their parts
    go to slots by hash. Other keys go by range, so places of a block are as near each other whatever the
    number of slots, and their differences take as few bytes."""
    shared = texts.sparkSession.sparkContext.broadcast(counts)

    def blocks(held: list[tuple[np.ndarray, ...]]):
        place, entry, n, rest = (np.concatenate(c) for c in zip(*held))
        with np.errstate(over="ignore"):
            by_hash = (_mix(place.view(np.uint64)) % np.uint64(slots)).astype(np.int64)
        by_range = ((place.view(np.uint64) * np.uint64(slots)) >> np.uint64(KEY_BITS)).astype(np.int64)
        dealt = place < 0
        group = 2 * np.where(dealt, by_hash, by_range) + dealt  # blocks hold one kind
        order = np.lexsort((place.view(np.uint64), group))
        group = group[order]
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        out = {"slot": [], "block": []}
        for start, end in zip(starts, [*starts[1:], len(group)]):
            rows = order[start:end]
            out["slot"].append(int(group[start]) // 2)
            out["block"].append(_pack(place[rows], entry[rows], n[rows], rest[rows]))
        return out

    def run(batches):
        maker, seen, held, size = Keys(shared.value, light_below), _Seen(), [], 0
        for b in batches:
            for shingles in (x for group in _pieces(b["text"]) for x in shingle_sets(group)):
                if not len(shingles) or seen.add(entry := entry_of(shingles)):
                    continue
                keys, parts, rest = maker.of(shingles)
                part = (entry & 0x7FFFFFFFFFFF) % np.minimum(np.maximum(parts, 1), MAX_PARTS)
                place = _signed(keys >> np.uint64(64 - KEY_BITS)) | (part << KEY_BITS)
                held.append((np.where(parts > 1, ~place, place), np.full(len(keys), entry, dtype=np.int64),
                             np.full(len(keys), len(shingles), dtype=np.int64), rest.astype(np.int64)))
                size += len(keys)
                if size >= BLOCK_ROWS:
                    yield blocks(held)
                    held, size = [], 0
        if size:
            yield blocks(held)

    return map_batches(texts.select("text"), run, "slot int, block binary", BATCH_BYTES)


class _Seen:
    """Which entries a task has had; forgets all of them from a number on, then rows may repeat."""

    def __init__(self):
        self.entries: set[int] = set()

    def add(self, entry: int) -> bool:
        if entry in self.entries:
            return True
        if len(self.entries) >= MOST_SEEN:
            self.entries.clear()
        self.entries.add(entry)
        return False


def _firsts(groups: np.ndarray, *by: np.ndarray) -> np.ndarray:
    """For each group, numbered 0, 1, ..., the row that is first by the given columns."""
    order = np.lexsort((*reversed(by), groups))
    return order[np.flatnonzero(np.diff(groups[order], prepend=-1))]


def _useful(place: np.ndarray, entry: np.ndarray, n: np.ndarray, rest: np.ndarray):
    """Rows of a slot that may have a partner, and the centres of their lists.

    Returns place, entry, n, rest of those rows and, as rows of another such table, the number of the
    row's list; `centres` holds four rows for each list: its smallest and largest entry, and two with
    the key early in their order. `left` are the useful rows of which a pair may not hold a centre.
    """
    order = np.lexsort((-rest, entry, place))  # of repeated rows the one with the larger rest
    place, entry, n, rest = (c[order] for c in (place, entry, n, rest))
    new = np.ones(len(place), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (entry[1:] != entry[:-1])
    place, entry, n, rest = (c[new] for c in (place, entry, n, rest))
    begins = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    ends = np.append(begins[1:], len(place)) - 1
    lists = np.repeat(np.arange(len(begins)), ends - begins + 1)
    early, first = _firsts(lists, -rest, -entry), _firsts(lists, -rest, entry)
    # A row whose place leaves too little even for the smallest possible partner of its list is of no
    # use; a list in parts is not known as a whole here.
    partner = np.maximum(np.minimum.reduceat(n, begins)[lists], -(-n * SHARE[0] // SHARE[1]))
    enough = (SHARE[0] + SHARE[1]) * rest >= SHARE[0] * (n + partner)
    several = (ends > begins)[lists]
    live = np.flatnonzero((several & enough) | (place < 0))
    centres = np.stack([begins, ends, early, first])
    # A whole list's centres are compared with all its rows; the others need a second one among them.
    apart = np.ones(len(place), dtype=bool)
    apart[centres.ravel()] = False
    others = live[apart[live]]
    two = np.bincount(lists[others], minlength=len(begins)) > 1
    left = live[(place[live] < 0) | (apart[live] & two[lists[live]])]
    return (place, entry, n, rest), live, lists, centres, left


def _lists(blocks: DataFrame, slots: int) -> DataFrame:
    """One written table of two kinds of rows.

    With `b` null, rows of keys that several entries have, but for pairs with a centre of a whole list:
    `(key, dealt, entry, n, rest)`, and `low`, the smallest entry of the part, where the list is dealt to parts. Else pairs `(entry, b)` of an entry with
    a centre of its part, smaller one first, where sizes and places allow enough common elements.
    """
    dealt = blocks.repartitionById(slots, "slot").select("block")

    def run(batches):
        parts = [_unpack(block) for b in batches for block in b["block"]]
        if not parts:
            return
        rows, live, lists, centres, left = _useful(*(np.concatenate(c) for c in zip(*parts)))
        del parts
        place, entry, n, rest = rows
        found = []
        for centre in centres:
            c = centre[lists[live]]
            fits = (SHARE[0] + SHARE[1]) * np.minimum(rest[live], rest[c]) >= SHARE[0] * (n[live] + n[c])
            some = fits & (entry[live] != entry[c])
            x, y = entry[live][some], entry[c][some]
            found.append(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1))
        pairs = np.unique(np.concatenate(found), axis=0)
        for at in range(0, len(left), OUT_ROWS):
            i = left[at:at + OUT_ROWS]
            whole = np.where(place[i] < 0, ~place[i], place[i]) & ((1 << KEY_BITS) - 1)
            low = centres[0][lists[i]]
            yield {"key": whole, "dealt": place[i] < 0, "entry": entry[i], "n": n[i], "rest": rest[i],
                   "low_entry": entry[low], "low_n": n[low], "low_rest": rest[low], "b": [None] * len(i)}
        for at in range(0, len(pairs), OUT_ROWS):
            a, b = pairs[at:at + OUT_ROWS].T
            none = [None] * len(a)
            yield {"entry": a, "b": b} | {c: none for c in (
                "key", "dealt", "n", "rest", "low_entry", "low_n", "low_rest")}

    schema = ("key long, dealt boolean, entry long, n int, rest int, low_entry long, low_n int, low_rest int, b long")
    return materialize(map_batches(dealt, run, schema), "shingle-lists")


def _fits(n: str, rest: str, m: str, other_rest: str) -> Column:
    """Whether the sizes allow enough common elements, given the place of a common key in both.

    The first common key of two similar sets passes: all common elements stand from there on.
    """
    return (F.lit(SHARE[0] + SHARE[1]) * F.least(rest, other_rest).cast("long")) >= (
        F.lit(SHARE[0]) * (F.col(n).cast("long") + F.col(m)))


def _pair(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _star_pairs(lists: DataFrame) -> DataFrame:
    """Each entry with the centres of its part, and the first centres of a key's parts with one of them."""
    near = lists.filter("b IS NOT NULL").select(F.col("entry").alias("a"), "b")
    low = F.struct(F.col("low_entry").alias("entry"), F.col("low_n").alias("n"), F.col("low_rest").alias("rest"))
    first = lists.filter("dealt").select("key", low.alias("low")).distinct()
    one = first.groupBy("key").agg(F.min("low").alias("c"))
    far = first.join(one, "key").select("low.entry", "low.n", "low.rest", F.col("c.entry").alias("c"),
                                        F.col("c.n").alias("cn"), F.col("c.rest").alias("cr"))
    apart = far.filter((F.col("entry") != F.col("c")) & _fits("n", "rest", "cn", "cr"))
    return near.union(apart.select(*_pair("entry", "c"))).distinct()


def _small(df: DataFrame) -> DataFrame:
    """A written table of a few numbers a row, broadcast if its rows are counted to be few."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _entries(pairs: DataFrame) -> DataFrame:
    return materialize(pairs.select(F.explode(F.array("a", "b")).alias("entry")).distinct(), "entries-of-pairs")


def _made(texts: DataFrame, entries: DataFrame, make: Callable[[np.ndarray], bytes]) -> DataFrame:
    """`(entry, n, made)` of the given written entries, made from the texts again; a filter of a fixed size
    keeps most of the others from being made."""
    marks = entries.select(F.pmod("entry", F.lit(MARKS)).cast("int").alias("m")).distinct().toArrow()
    bits = np.zeros(MARKS, dtype=bool)
    bits[marks.column("m").to_numpy()] = True
    shared = texts.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def run(batches):
        wanted, seen = np.unpackbits(shared.value), _Seen()
        for b in batches:
            out, size = {"entry": [], "n": [], "made": []}, 0
            for shingles in (x for group in _pieces(b["text"]) for x in shingle_sets(group)):
                if not len(shingles):
                    continue
                entry = entry_of(shingles)
                if wanted[entry % MARKS] and not seen.add(entry):
                    out["entry"].append(entry)
                    out["n"].append(len(shingles))
                    out["made"].append(make(shingles))
                    size += len(out["made"][-1])
                    if size >= BATCH_BYTES:
                        yield out
                        out, size = {c: [] for c in out}, 0
            yield out

    rows = map_batches(texts.select("text"), run, "entry long, n long, made binary", BATCH_BYTES)
    kept = rows.join(_small(entries), "entry", "left_semi")
    return materialize(kept.dropDuplicates(["entry"]), "sets-of-entries")


def _with_both(pairs: DataFrame, made: DataFrame) -> DataFrame:
    """`(a, b, x, y, n, m)`: what was made of both entries of written pairs, and the sizes of both."""
    x, y = (made.select(F.col("entry").alias(e), F.col("made").alias(v), F.col("n").alias(size))
            for e, v, size in (("a", "x", "n"), ("b", "y", "m")))
    return x.join(_small(pairs), "a").join(y, "b").select("a", "b", "x", "y", "n", "m")


def _verified(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The written pairs `(a, b)` whose whole sets are similar. Sketches come first: whole sets are long,
    and are made and sent for the pairs only that sketches leave."""
    def possible(batches):
        for b in batches:
            n, m = (np.array(b[c], dtype=np.int64) for c in ("n", "m"))
            most = np.array([most_common(*row) for row in zip(b["x"], b["y"], b["n"], b["m"])], dtype=np.int64)
            ok = similar(most, n, m)
            yield {c: [v for v, keep in zip(b[c], ok) if keep] for c in ("a", "b")}

    def run(batches):
        for b in batches:
            x, y = ([np.frombuffer(s, np.uint64) for s in b[c]] for c in ("x", "y"))
            common = np.array([len(p) + len(q) - len(np.union1d(p, q)) for p, q in zip(x, y)], dtype=np.int64)
            ok = similar(common, np.array([len(p) for p in x]), np.array([len(q) for q in y]))
            yield {c: [v for v, keep in zip(b[c], ok) if keep] for c in ("a", "b")}

    for name, make, keep in (("possible-pairs", sketch_of, possible), ("links", np.ndarray.tobytes, run)):
        if pairs.isEmpty():
            return pairs
        both = _with_both(pairs, _made(texts, _entries(pairs), make))
        pairs = materialize(map_batches(both, keep, "a long, b long", BATCH_BYTES), name)
    return pairs


def _open_lists(lists: DataFrame, links: DataFrame) -> DataFrame:
    """Rows of the lists that hold several components, with the largest one of the list, `main`."""
    roots = materialize(components(links).select(F.col("node").alias("entry"), "root"), "roots-of-entries")
    named = lists.select("key", "entry", "n", "rest").join(_small(roots), "entry", "left").select(
        "key", "entry", "n", "rest", F.coalesce("root", "entry").alias("root"))
    named = materialize(named, "named-lists")
    per_key = named.groupBy("key", "root").agg(F.count(F.lit(1)).alias("rows")).groupBy("key").agg(
        F.max_by("root", F.struct("rows", "root")).alias("main"), F.count(F.lit(1)).alias("roots"))
    open_keys = materialize(per_key.filter("roots > 1").select("key", "main"), "open-keys")
    return materialize(named.join(_small(open_keys), "key"), "open-lists")


def _open_pairs(lists: DataFrame) -> DataFrame:
    """All pairs of a list that are in different components."""
    rest = lists.filter("root <> main").select("key", F.col("entry").alias("e"), F.col("n").alias("m"),
                                               F.col("rest").alias("s"), F.col("root").alias("r"))
    pairs = rest.join(lists, "key").filter(
        (F.col("root") != F.col("r")) & _fits("n", "rest", "m", "s")
        & ((F.col("root") == F.col("main")) | (F.col("e") < F.col("entry"))))
    return pairs.select(*_pair("e", "entry")).distinct()


def shingle_links(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """`(doc_id, n_shingles, entry, h)` of every row, `h` being the hash of its text, and `(node, root)`
    of the entries with a link."""
    texts = texts_of(docs, key, text)
    facts = _facts(texts)
    counts = _bin_counts(facts)
    rows = facts.filter("NOT counts").select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "entry", "h")
    total = float(counts.sum())
    # Squares of the bins hold the squares of the shingles' counts and what chance puts together.
    lists = max(0.0, (float((counts.astype(float) ** 2).sum()) - total * total / BINS) / total - 1.0) if total else 0.0
    small = rows.filter(F.col("n_shingles").between(1, 2 * MAX_BORDER)).groupBy("n_shingles").count().collect()
    light_below = border([(r.n_shingles, r["count"]) for r in small], lists)
    slots = -(-_number_of_keys(rows, light_below) // SLOT_ROWS) or 1
    found = _lists(_key_blocks(texts, counts, light_below, slots), slots)
    listed = found.filter("b IS NULL")
    tried = materialize(_star_pairs(found), "star-pairs")
    links = _verified(texts, tried)
    pairs = _open_pairs(_open_lists(listed, links)).join(tried, ["a", "b"], "left_anti")
    return rows, components(links.union(_verified(texts, materialize(pairs, "open-pairs"))))


def _named(docs: DataFrame, key: str, text: str) -> DataFrame:
    rows, roots = shingle_links(docs, key, text)
    named = rows.join(roots.select(F.col("node").alias("entry"), "root"), "entry", "left").select(
        "doc_id", "h", "n_shingles", F.coalesce("root", "entry").alias("root"))
    return materialize(named, "rows-of-components")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: `doc_id, n_shingles, component_id`."""
    named = _named(docs, key, text)
    smallest = named.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least"))
    joined = named.join(smallest, "root", "left")
    return joined.select("doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(
        F.col("least")).alias("component_id"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs`, one of each component: the smallest id, then the smallest hash of the text.

    Rows without words stay. Rows that repeat as a whole key and text are reduced to one.
    """
    named = _named(docs, key, text).filter("root IS NOT NULL")
    first = named.groupBy("root").agg(F.min(F.struct(F.col("doc_id"), "h")).alias("first"))
    kinds = named.groupBy("root", "doc_id", "h").agg(F.count(F.lit(1)).alias("copies")).join(first, "root")
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("h") == F.col("first.h"))
    leaving = materialize(
        kinds.filter(~stays | (F.col("copies") > 1)).select(
            F.col("doc_id").alias("_id"), F.col("h").alias("_h"), stays.alias("_stays")), "leaving")
    few = leaving.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS

    def small(df):
        return F.broadcast(df) if few else df

    same = F.col("_id").eqNullSafe(F.col(f"_docs.{key}").cast("long")) & (
        F.col("_h") == F.xxhash64(F.coalesce(F.col(f"_docs.{text}"), F.lit(""))))
    kept = docs.alias("_docs").join(small(leaving.select("_id", "_h")), same, "left_anti")
    repeated = docs.alias("_docs").join(small(leaving.filter("_stays").select("_id", "_h")), same, "left_semi")
    return kept.union(repeated.dropDuplicates([key, text]))
