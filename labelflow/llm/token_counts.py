"""Token counts of a byte-fallback piece model by rank-synchronous merging of ragged arrays.

Texts are cut into pre-tokens (a run of word marks and the characters up to the next one) because
no piece of the vocabulary has a mark behind another character. Distinct pre-tokens of a batch are
held as one flat array of symbol ids with sequence borders. In each round every sequence applies
its own best-ranked pair, all of them at once, and looks up only the pairs that are new; sequences
without a pair left drop out. What survives is counted: a known symbol is one token, an unknown
character as many as its UTF-8 bytes.

Repeated rows give repeated results; null and empty texts have no token.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from labelflow.llm.common import map_batches, texts_of

MARK = "▁"  # stands for a space in the model's pieces
NORMAL = 1  # type of the pieces that merges may form
# Longer pre-tokens are merged one by one with a heap, which is linear but for a logarithm;
# rounds over the whole array would be quadratic there.
LONG = 512
CACHED = 1 << 19  # distinct pre-tokens remembered by a worker
OUTPUT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

_PRE_TOKEN = re.compile(f"{MARK}+[^{MARK}]*")
_NO_PAIR = np.int64(1) << 62


class Merger:
    """Vocabulary of a piece model as sorted arrays: pair of symbols -> rank and merged symbol."""

    def __init__(self, pieces: list[str], scores: list[float]):
        """`pieces`: those that merges may form, with their scores; the best score is merged first."""
        self.symbol = {p: i for i, p in enumerate(pieces)}
        self.n = len(pieces) + 1  # the last number stands for every unknown character
        order = sorted(set(scores), reverse=True)
        rank_of = {s: r for r, s in enumerate(order)}
        pairs = {}
        for piece, score in zip(pieces, scores):
            for cut in range(1, len(piece)):
                left, right = self.symbol.get(piece[:cut]), self.symbol.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * self.n + right] = (rank_of[score], self.symbol[piece])
        keys = np.array(sorted(pairs), dtype=np.int64)
        self.keys = keys
        self.rank = np.array([pairs[k][0] for k in keys.tolist()], dtype=np.int64)
        self.merged = np.array([pairs[k][1] for k in keys.tolist()], dtype=np.int64)
        self.pairs = pairs

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index into `rank` and `merged` of each pair, -1 where no merge exists."""
        if not len(self.keys):
            return np.full(len(left), -1, dtype=np.int64)
        key = left * self.n + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, at, -1)

    def symbols(self, text: str) -> list[int]:
        unknown = self.n - 1
        return [self.symbol.get(c, unknown) for c in text]

    def weight(self, text: str, symbols: list[int]) -> int:
        """Tokens beyond one each that unknown characters add; they never merge."""
        unknown = self.n - 1
        if unknown not in symbols:
            return 0
        return sum(len(c.encode()) - 1 for c, s in zip(text, symbols) if s == unknown)

    def count(self, words: list[str]) -> np.ndarray:
        """Number of tokens of each pre-token."""
        counts = np.zeros(len(words), dtype=np.int64)
        flat: list[int] = []
        lengths, short = [], []
        for i, word in enumerate(words):
            symbols = self.symbols(word)
            counts[i] = self.weight(word, symbols)
            if len(symbols) > LONG:
                counts[i] += self._count_long(symbols)
            elif symbols:
                flat += symbols
                lengths.append(len(symbols))
                short.append(i)
        if short:
            counts[short] += self._count_ragged(np.array(flat, dtype=np.int64), np.array(lengths))
        return counts

    def _count_ragged(self, sym: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        alive = lengths.astype(np.int64).copy()
        where = np.arange(len(lengths))
        # found[i]: merge of symbol i with its right neighbour; -1 at the end of a sequence.
        seq = np.repeat(where, lengths)
        found = np.full(len(sym), -1, dtype=np.int64)
        inside = seq[:-1] == seq[1:]
        found[:-1][inside] = self.lookup(sym[:-1][inside], sym[1:][inside])
        while len(where):
            size = alive[where]
            start = np.concatenate(([0], np.cumsum(size)[:-1]))
            position = np.arange(len(sym))
            # Equal ranks go to the leftmost pair.
            key = np.where(found >= 0, self.rank[found] << 32 | position, _NO_PAIR)
            best = np.minimum.reduceat(key, start)
            can = best < _NO_PAIR
            at = best[can] & 0xFFFFFFFF
            sym[at] = self.merged[found[at]]
            first = start[can]
            # The right part leaves, and so do sequences without a pair.
            keep = np.repeat(can, size)
            keep[at + 1] = False
            ends = first + size[can] - 1  # last symbol of the sequence, before the removal
            found[at] = -1
            has_left = at > first
            has_right = at + 1 < ends
            left, right = at[has_left], at[has_right]
            found[left - 1] = self.lookup(sym[left - 1], sym[left])
            found[right] = self.lookup(sym[right], sym[right + 2])
            sym, found = sym[keep], found[keep]
            where = where[can]
            alive[where] -= 1
        return alive

    def _count_long(self, symbols: list[int]) -> int:
        """The same merges for one long sequence, with a heap of pairs and a linked list."""
        n, sym = len(symbols), list(symbols)
        after, before = list(range(1, n)) + [-1], list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (pair := self.pairs.get(sym[i] * self.n + sym[j])):
                heapq.heappush(heap, (pair[0], i, sym[i], sym[j]))

        for i in range(n):
            offer(i)
        left = n
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if sym[i] != a or j < 0 or sym[j] != b:
                continue  # one side has changed since
            sym[i] = self.pairs[a * self.n + b][1]
            sym[j] = -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            left -= 1
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return left


@lru_cache(maxsize=2)
def load(path: str) -> tuple[Merger, dict[str, int]]:
    """The model's merge table and the worker's memory of counted pre-tokens, once per worker."""
    from sentencepiece import SentencePieceProcessor
    from sentencepiece import sentencepiece_model_pb2 as proto

    with open(path, "rb") as f:
        raw = f.read()
    model = proto.ModelProto()
    model.ParseFromString(raw)
    spec = model.normalizer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
        raise ValueError("only models that keep the text as it is are supported")
    SentencePieceProcessor(model_proto=raw)  # fails on a damaged file
    normal = [(p.piece, p.score) for p in model.pieces if p.type == NORMAL]
    if any(MARK in p.lstrip(MARK) for p, _ in normal):
        raise ValueError("pieces run over a word mark, so texts can't be cut there")
    return Merger([p for p, _ in normal], [s for _, s in normal]), {}


def pre_tokens(text: str) -> list[str]:
    return _PRE_TOKEN.findall(MARK + text.replace(" ", MARK)) if text else []


def count_texts(texts: list[str], path: str) -> list[int]:
    merger, cache = load(path)
    out = []
    pending: list[list[str]] = []
    missing: dict[str, None] = {}
    waiting = 0

    def flush() -> None:
        nonlocal waiting
        words = list(missing)
        new = dict(zip(words, merger.count(words).tolist()))
        for tokens in pending:
            out.append(sum([cache[w] if w in cache else new[w] for w in tokens]))
        if len(cache) + len(new) > CACHED:
            cache.clear()
        # Very long pre-tokens are rare and would fill the memory of the worker.
        cache.update((w, n) for w, n in new.items() if len(w) <= 64)
        pending.clear()
        missing.clear()
        waiting = 0

    for text in texts:
        tokens = pre_tokens(text)
        pending.append(tokens)
        missing.update(dict.fromkeys([w for w in tokens if w not in cache]))
        waiting += len(text)
        if waiting > 2_000_000:
            flush()
    flush()
    return out


def token_counts(
    docs: DataFrame, model_path: str, limit: int = 4096, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row `doc_id, n_bytes, n_tokens, over_limit`, whole texts, one pass and no shuffle."""
    def run(batches):
        for b in batches:
            counts = count_texts(b["text"], model_path)
            yield {
                "doc_id": b["doc_id"],
                "n_bytes": [len(t.encode()) for t in b["text"]],
                "n_tokens": counts,
                "over_limit": [n > limit for n in counts],
            }

    return map_batches(texts_of(docs, key, text), run, OUTPUT)
