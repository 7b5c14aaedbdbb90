"""Token ids in shard files with a minimal perfect hash index for keyed access.

A shard is two files. `.ids` holds nothing but the ids of its documents, one after the other, as
little-endian unsigned integers of 2 bytes (4 where the vocabulary needs them). `.mph` holds, after
a header, the levels of a minimal perfect hash over the shard's keys, and for each slot of that
hash a stored fingerprint of the key, the offset and the number of ids; then the keys in file
order. A key is a doc_id (or null) and its occurrence among equal ones. A lookup costs a few bit
tests and one read, whatever the number of keys; the fingerprint tells absent keys apart.

Rows are sorted by doc_id (null first), then by a hash of the text and the text, into one range per
shard; equal doc_ids may so spread over shards. Each attempt of a task writes files of its own
names, and a manifest table lists the files of the attempts that ended well, with the number of ids
in all shards before. Reading goes by the manifest, so lost executors leave unused files at most.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelflow.llm.common import CHUNK_CHARS, map_batches, texts_of
from labelflow.scale import materialize, scratch_path

OUTPUT = "doc_id long, start long, n_tokens long, ids_crc32 long"
MANIFEST = ("shard int, path string, docs long, ids long, first_doc long, last_doc long, width int")
MAGIC = 0x31485049  # "IPH1"
GAMMA = 1.5  # bits of a level for each key that reaches it
END_ID = 2

CACHED = 400_000  # encoded words that a worker remembers from one batch to the next
LONG_WORD = 64  # longer ones are not remembered
JOINED = 50  # words that go to the library as one text
BATCH_CHARS = 16 * CHUNK_CHARS  # texts are encoded together up to so many characters

# Encoding ---------------------------------------------------------------------------------------


class _Words:
    """Encoded words that a worker remembers, as two Arrow arrays: the words, and the ids of each as bytes."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.words, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def keep(self, words: pa.Array, ids: pa.Array) -> None:
        if len(self.words) + len(words) > CACHED:
            self.clear()
            return
        short = pc.less_equal(pc.binary_length(words), LONG_WORD)
        self.words = pa.concat_arrays([self.words, words.filter(short)])
        self.ids = pa.concat_arrays([self.ids, ids.filter(short)])


@lru_cache(maxsize=2)
def _encoder(path: str):
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    # A token of a byte-level vocabulary is spelled with one character for each of its bytes.
    size = np.zeros(tokenizer.get_vocab_size(), dtype=np.int64)
    for token, i in tokenizer.get_vocab().items():
        size[i] = len(token)
    return tokenizer, special, size, _Words()


# White space other than the space.
_WHITE = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "]


def _can_cut(text: str) -> bool:
    """Whether all spaces of the text stand alone: between two characters that are no white space.

    The pre-tokenizer may keep a run of white space together, but never lets a token run into a space
    between two other characters, nor does a cut before it change how the parts are split, so parts
    can be encoded alone, each but the first with its space.
    """
    if not text or text[0] == " " or text[-1] == " " or "  " in text:
        return False
    return not any(c in text and (f" {c}" in text or f"{c} " in text) for c in _WHITE)


def _binary(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Ids as one binary value for each range that ends at `ends`."""
    offsets = np.concatenate(([0], ends)).astype(np.int64) * 4
    return pa.Array.from_buffers(
        pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(ids))])


def _ids_of(encoded: list) -> np.ndarray:
    return np.concatenate([np.empty(0, "<u4"), *(np.array(e.ids, dtype="<u4") for e in encoded)])


def _encode_words(words: pa.Array, tokenizer, size: np.ndarray) -> pa.Array:
    """Ids of a space and each word, as bytes. Words are encoded joined, since no token runs over
    their borders, and the ids are told apart by the number of bytes that they stand for."""
    texts = words.to_pylist()
    ids = _ids_of(tokenizer.encode_batch_fast(
        [" " + " ".join(texts[at:at + JOINED]) for at in range(0, len(texts), JOINED)], add_special_tokens=False))
    ends = np.cumsum(pc.binary_length(words).to_numpy() + 1)
    return _binary(ids, np.searchsorted(np.cumsum(size[ids]), ends) + 1)


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `BATCH_CHARS` characters, or of one longer text."""
    at, chars = 0, 0
    for i, t in enumerate(texts):
        if i > at and chars + len(t) > BATCH_CHARS:
            yield at, i
            at, chars = i, 0
        chars += len(t)
    if texts:
        yield at, len(texts)


def encode_texts(texts: list[str], path: str, end_id: int = END_ID) -> list[np.ndarray]:
    """Ids of whole texts as the library gives them, and the end id behind each.

    Texts are cut into words, equal words get one code, and the library sees each word once, or never
    if it was met before; the ids are gathered by code. Texts that hold an added token or unusual gaps
    go to the library whole.
    """
    tokenizer, special, size, cache = _encoder(path)
    if not texts:
        return []
    cut = [_can_cut(t) and not any(s in t for s in special) for t in texts]
    # A text that can't be cut is a first word, and has no others.
    first = tokenizer.encode_batch_fast(
        [t.partition(" ")[0] if c else t for t, c in zip(texts, cut)], add_special_tokens=False)
    parts = pc.split_pattern(pa.array([t if c else "" for t, c in zip(texts, cut)], pa.large_string()), " ")
    bounds = parts.offsets.to_numpy().astype(np.int64)
    rows = np.arange(len(texts))
    later = np.ones(bounds[-1], dtype=bool)
    later[bounds[:-1]] = False  # first words stay out: they may begin with white space, which joins with others'
    coded = parts.flatten().filter(pa.array(later)).dictionary_encode()
    words = coded.dictionary
    known = pc.index_in(words, value_set=cache.words)
    new = words.filter(known.is_null())
    ids = _encode_words(new, tokenizer, size)

    # The ids of remembered words, of new ones, of the end, and of each first word.
    n_known = len(cache.words)
    end = n_known + len(new)
    firsts = _binary(_ids_of(first), np.cumsum([len(e.ids) for e in first]))
    pool = pa.concat_arrays([cache.ids, ids, _binary(np.array([end_id], dtype="<u4"), np.array([1])), firsts])
    place = known.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    place[place < 0] = n_known + np.arange(len(new))
    cache.keep(new, ids)

    # Where a text begins stands its first word, and behind its words the end.
    codes = np.empty(bounds[-1], dtype=np.int64)
    codes[bounds[:-1]] = end + 1 + rows
    codes[later] = place[coded.indices.to_numpy()]
    codes = np.insert(codes, bounds[1:], end)
    taken = pool.take(pa.array(codes))
    offsets = np.frombuffer(taken.buffers()[1], np.int64, len(codes) + 1, taken.offset * 8) // 4
    all_ids = np.frombuffer(taken.buffers()[2], "<u4", int(offsets[-1]))
    return np.split(all_ids[offsets[0]:], (offsets[bounds[1:] + rows + 1] - offsets[0])[:-1])


# Minimal perfect hash ---------------------------------------------------------------------------


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finalizer: every bit of the input and the seed reaches every bit of the output."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def key_hash(doc_ids: np.ndarray, null: np.ndarray, occurrence: np.ndarray, seed: int) -> np.ndarray:
    inner = _mix(occurrence.astype(np.int64).view(np.uint64) * np.uint64(2) + null.astype(np.uint64), seed + 1)
    return _mix(doc_ids.astype(np.int64).view(np.uint64) ^ inner, seed + 2)


class PerfectHash:
    """Levels of bit arrays: a key is placed at the first level where it meets no other key."""

    def __init__(self, sizes: list[int], words: np.ndarray, seed: int):
        self.sizes, self.words, self.seed = sizes, words, seed
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words).astype(np.int64))))
        self.base = np.concatenate(([0], np.cumsum([s // 64 for s in sizes]))).astype(np.int64)

    @staticmethod
    def build(hashes: np.ndarray, seed: int) -> PerfectHash | None:
        """None when two keys share a hash; another seed will part them."""
        sizes, words, left = [], [], hashes
        for level in range(64):
            if not len(left):
                break
            size = max(64, -(-int(len(left) * GAMMA) // 64) * 64)
            at = (_mix(left, level + 11) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            bits = np.packbits(alone, bitorder="little").view("<u8")
            sizes.append(size)
            words.append(bits)
            left = left[~alone[at]]
        if len(left):
            return None
        return PerfectHash(sizes, np.concatenate(words) if words else np.empty(0, "<u8"), seed)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of each key in 0..n-1; an absent key gets any slot or -1."""
        slot = np.full(len(hashes), -1, dtype=np.int64)
        open_ = np.arange(len(hashes))
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            at = (_mix(hashes[open_], level + 11) % np.uint64(size)).astype(np.int64)
            word = self.base[level] + (at >> 6)
            bit = (at & 63).astype(np.uint64)
            value = self.words[word]
            hit = (value >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(value & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            slot[open_[hit]] = (self.before[word] + below)[hit]
            open_ = open_[~hit]
        return slot


def occurrences(doc_ids: np.ndarray, null: np.ndarray) -> np.ndarray:
    """Place of each key among equal ones; equal keys stand together."""
    n = len(doc_ids)
    if not n:
        return np.empty(0, np.int64)
    new = np.ones(n, dtype=bool)
    new[1:] = (doc_ids[1:] != doc_ids[:-1]) | (null[1:] != null[:-1])
    start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    return np.arange(n) - start


_SLOT = np.dtype([("fingerprint", "<u4"), ("n", "<u4"), ("offset", "<u8")])


def index_bytes(doc_ids: np.ndarray, null: np.ndarray, counts: np.ndarray, width: int) -> bytes:
    occurrence = occurrences(doc_ids, null)
    for seed in range(1, 100):
        hashes = key_hash(doc_ids, null, occurrence, seed)
        perfect = PerfectHash.build(hashes, seed)
        if perfect is not None:
            break
    else:
        raise RuntimeError("no seed parts the keys")
    table = np.empty(len(doc_ids), dtype=_SLOT)
    slot = perfect.slots(hashes)
    table["fingerprint"][slot] = _mix(hashes, 5) >> np.uint64(32)
    table["n"][slot] = counts
    table["offset"][slot] = np.concatenate(([0], np.cumsum(counts)[:-1])) if len(counts) else []
    head = np.array([MAGIC, width, len(doc_ids), seed, len(perfect.sizes), *perfect.sizes], dtype="<i8")
    return b"".join([head.tobytes(), perfect.words.astype("<u8").tobytes(), table.tobytes(),
                     doc_ids.astype("<i8").tobytes(), null.astype("u1").tobytes()])


class Shard:
    """A shard's index, and its ids by key."""

    def __init__(self, path: str):
        self.fs, self.path = _store(path)
        with self.fs.open_input_stream(self.path + ".mph") as f:
            raw = f.read()
        head = np.frombuffer(raw, "<i8", 5)
        if head[0] != MAGIC:
            raise ValueError(f"no index: {path}")
        self.width, n, seed, levels = (int(x) for x in head[1:])
        at = 40
        sizes = np.frombuffer(raw, "<i8", levels, at).tolist()
        at += 8 * levels
        words = np.frombuffer(raw, "<u8", sum(sizes) // 64, at)
        at += words.nbytes
        self.perfect = PerfectHash(sizes, words, seed)
        self.table = np.frombuffer(raw, _SLOT, n, at)
        at += self.table.nbytes
        self.doc_ids = np.frombuffer(raw, "<i8", n, at)
        self.null = np.frombuffer(raw, "u1", n, at + 8 * n).astype(bool)

    def find(self, doc_ids: np.ndarray, null: np.ndarray, occurrence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offset and number of ids of each key, -1 where the shard lacks it."""
        if not len(self.table):
            return np.full(len(doc_ids), -1), np.full(len(doc_ids), -1)
        hashes = key_hash(doc_ids, null, occurrence, self.perfect.seed)
        slot = self.perfect.slots(hashes)
        got = self.table[np.maximum(slot, 0)]
        known = (slot >= 0) & (got["fingerprint"] == (_mix(hashes, 5) >> np.uint64(32)).astype("<u4"))
        return np.where(known, got["offset"].astype(np.int64), -1), np.where(known, got["n"].astype(np.int64), -1)

    def get(self, doc_id: int | None, occurrence: int = 0) -> np.ndarray | None:
        """Ids of one document by its key, None if the shard lacks it."""
        offset, n = self.find(np.array([doc_id or 0]), np.array([doc_id is None]), np.array([occurrence]))
        if offset[0] < 0:
            return None
        with self.fs.open_input_file(self.path + ".ids") as f:
            f.seek(int(offset[0]) * self.width)
            return np.frombuffer(f.read(int(n[0]) * self.width), f"<u{self.width}").astype("<u4")


def _store(path: str):
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


# Spark ------------------------------------------------------------------------------------------


def write_ids(docs: DataFrame, tokenizer_path: str, folder: str | None = None, shards: int | None = None,
              end_id: int = END_ID, vocabulary: int = 50_257, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every whole text and write the shards; returns the written manifest.

    `folder` must be one that all executors share; by default it lies in `spark.checkpoint.dir`.
    A task holds one batch of texts and 17 bytes a document of its shard.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "ids")
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    width = 2 if max(vocabulary, end_id + 1) <= 1 << 16 else 4
    rows = texts_of(docs, key, text).withColumn("h", F.xxhash64("text"))
    order = ["doc_id", "h", "text"]
    dealt = rows.repartitionByRange(shards, "doc_id", "h").sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches):
        shard = TaskContext.get().partitionId()
        path = f"{folder}/{shard:06d}-{uuid.uuid4().hex[:12]}"
        fs, local = _store(path)
        fs.create_dir(local.rsplit("/", 1)[0], recursive=True)
        doc_ids, null, counts = [], [], []
        with fs.open_output_stream(local + ".ids") as f:
            for b in batches:
                for at, end in _slices(b["text"]):
                    ids = encode_texts(b["text"][at:end], tokenizer_path, end_id)
                    f.write(b"".join(x.astype(f"<u{width}").tobytes() for x in ids))
                    counts.append(np.array([len(x) for x in ids], dtype=np.int64))
                    some = b["doc_id"][at:end]
                    doc_ids.append(np.array([d or 0 for d in some], dtype=np.int64))
                    null.append(np.array([d is None for d in some], dtype=bool))
        if not counts:
            return
        all_ids, all_null, all_counts = (np.concatenate(x) for x in (doc_ids, null, counts))
        with fs.open_output_stream(local + ".mph") as f:
            f.write(index_bytes(all_ids, all_null, all_counts, width))
        first, last = (None if all_null[i] else int(all_ids[i]) for i in (0, -1))
        yield {"shard": [shard], "path": [path], "docs": [len(all_ids)], "ids": [int(all_counts.sum())],
               "first_doc": [first], "last_doc": [last], "width": [width]}

    return materialize(map_batches(dealt, run, MANIFEST), "manifest")


def read_ids(manifest: DataFrame) -> DataFrame:
    """Per document of the shards its place and checksum, as `OUTPUT`, through the index by key.

    The running sum is over the manifest, one row a shard.
    """
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    starts = manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        for b in batches:
            for path, start in zip(b["path"], b["start"]):
                shard = Shard(path)
                offset, n = shard.find(shard.doc_ids, shard.null, occurrences(shard.doc_ids, shard.null))
                if (offset < 0).any():
                    raise ValueError(f"damaged index: {path}")
                with shard.fs.open_input_file(shard.path + ".ids") as f:
                    at = 0
                    while at < len(offset):
                        # As many documents as fit some megabytes, at least one, with one read.
                        end = max(at + 1, int(np.searchsorted(offset, offset[at] + 2_000_000)))
                        f.seek(int(offset[at]) * shard.width)
                        ids = np.frombuffer(f.read(int(n[at:end].sum()) * shard.width), f"<u{shard.width}").astype("<u4")
                        local = offset[at:end] - offset[at]
                        yield {
                            "doc_id": [None if z else int(d) for d, z in zip(shard.doc_ids[at:end], shard.null[at:end])],
                            "start": start + offset[at:end], "n_tokens": n[at:end],
                            "ids_crc32": [zlib.crc32(ids[o:o + c]) for o, c in zip(local, n[at:end])],
                        }
                        at = end

    return map_batches(starts.select("path", "start").repartition(parts), run, OUTPUT)
