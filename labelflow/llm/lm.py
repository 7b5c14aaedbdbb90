"""Language-model scoring: a log-bilinear neural model, trained with noise-contrastive estimation.

Words are counted over all learning rows. The model predicts the class of each token from the two
tokens before it: the most frequent words are classes of their own, all others share a class by
their last two bytes. A context is the sum of its class vectors, each times the matrix of its place;
its product with a class's output vector, plus a bias, is that class's score. Training in numpy
tells real tokens from noise drawn from the class counts; the noise of a batch is shared, so a step
is a few matrix products. Each task trains on its rows from the common parameters, and the results
are averaged by the number of tokens; the rows are dealt to a few such rounds, so all learning rows
are used once.

For scoring, the normaliser of every context of two classes is computed in batched matrix products,
so `P(class | context)` sums to one; `P(word | class)` is (c + 0.5) / (N + 0.5 (V + 1)) within the
class. Counts of the frequent words go to every task (a fixed number of words), all other words of a
text are joined with the count table by word.

A null text counts as an empty one: a single end token. Repeated rows are learned from and scored
each. Without any learning row the counts are zero and the model is uniform.
"""

from __future__ import annotations

import zlib
from collections import Counter
from functools import lru_cache
from itertools import repeat

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelflow.llm.common import fold, map_batches, texts_of
from labelflow.scale import materialize

CLASSES, OWN = 512, 256  # classes; the first OWN are the end token and single words
WIDTH, CONTEXT = 24, 2
NOISE, BATCH, ROUNDS, RATE, SEED = 32, 2048, 2, 0.1, 5
FREQUENT = 1 << 18  # words whose counts go to every task
HELD_WORDS = 200_000  # distinct words that a task counts before it hands them on
END = b""
OUTPUT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")


def words_of(text: str) -> list[bytes]:
    """Words of the lower-cased (A-Z) text and the end token.

    On bytes, lower() changes A-Z only and split() cuts at the six ASCII white-space characters.
    """
    return [*text.encode("utf-8", "surrogatepass").lower().split(), END]


@lru_cache(maxsize=1 << 16)
def _suffix_class(suffix: bytes) -> int:
    return OWN + zlib.crc32(suffix) % (CLASSES - OWN)


def shared_class(word: bytes) -> int:
    return _suffix_class(word[-2:])


class _Classes(dict):
    """Class of each word, remembered up to a bound beside the words with a class of their own."""

    def __init__(self, own: dict[bytes, int]):
        super().__init__(own)
        self.own = own

    def __missing__(self, word: bytes) -> int:
        if len(self) > HELD_WORDS:
            self.clear()
            self.update(self.own)
        value = self[word] = shared_class(word)
        return value


# Counts -----------------------------------------------------------------------------------------


def count_words(rows: DataFrame) -> DataFrame:
    """`(word, cls, c)` over all rows, as a written table."""
    def run(batches):
        counts: Counter[bytes] = Counter()

        def out():
            words = list(counts)
            return {"word": words, "cls": [shared_class(w) for w in words], "n": list(counts.values())}

        for b in batches:
            for t in b["text"]:
                counts.update(words_of(t))
                if len(counts) > HELD_WORDS:
                    yield out()
                    counts.clear()
        yield out()

    counted = map_batches(rows.select("text"), run, "word binary, cls int, n long")
    return materialize(counted.groupBy("word").agg(F.first("cls").alias("cls"), F.sum("n").alias("c")), "word-counts")


class Counts:
    """Totals, the frequent words, and the totals of each class of shared words."""

    def __init__(self, table: DataFrame):
        total = table.agg(F.sum("c"), F.count("word")).first()
        self.tokens, self.distinct = int(total[0] or 0), int(total[1] or 0)
        top = table.orderBy(F.desc("c"), "word").limit(FREQUENT).toArrow()  # a fixed number of rows
        words, counts = top.column("word").to_pylist(), top.column("c").to_pylist()
        self.frequent = dict(zip(words, counts))
        own = [END] + [w for w in words[:OWN] if w != END][:OWN - 1]
        self.own = {w: i for i, w in enumerate(own)}
        self.class_tokens, self.class_distinct = np.zeros(CLASSES), np.zeros(CLASSES)
        for r in table.groupBy("cls").agg(F.sum("c").alias("c"), F.count("word").alias("v")).collect():
            self.class_tokens[r.cls], self.class_distinct[r.cls] = r.c, r.v
        for w, i in self.own.items():
            if w in self.frequent:
                self.class_tokens[i] = self.frequent[w]
                self.class_tokens[shared_class(w)] -= self.frequent[w]
                self.class_distinct[shared_class(w)] -= 1


# Model ------------------------------------------------------------------------------------------


class Model:
    """Parameters: input vectors, a matrix for each place of the context, output vectors, biases."""

    def __init__(self, class_tokens: np.ndarray, vector: np.ndarray | None = None):
        self.squares: dict[str, np.ndarray] = {}
        # Every class may occur as noise and has a bias.
        share = (class_tokens + 0.5) / (class_tokens + 0.5).sum()
        self.noise = share.astype(np.float64)
        if vector is None:
            rng = np.random.default_rng(SEED)
            self.r = rng.normal(0, 0.1, (CLASSES, WIDTH)).astype(np.float32)
            self.c = np.stack([np.eye(WIDTH, dtype=np.float32) * s for s in (0.7, 0.3)])
            self.q = rng.normal(0, 0.1, (CLASSES, WIDTH)).astype(np.float32)
            self.b = np.log(share).astype(np.float32)
        else:
            parts = np.split(vector.astype(np.float32), np.cumsum(
                [CLASSES * WIDTH, CONTEXT * WIDTH * WIDTH, CLASSES * WIDTH]))
            self.r, self.q = parts[0].reshape(CLASSES, WIDTH), parts[2].reshape(CLASSES, WIDTH)
            self.c, self.b = parts[1].reshape(CONTEXT, WIDTH, WIDTH), parts[3]

    def vector(self) -> np.ndarray:
        return np.concatenate([self.r.ravel(), self.c.ravel(), self.q.ravel(), self.b])

    def step(self, near: np.ndarray, far: np.ndarray, target: np.ndarray, rng, rate: float) -> None:
        """One step of noise-contrastive estimation on a batch of classes and their contexts."""
        noise = rng.choice(CLASSES, NOISE, p=self.noise)
        r1, r2 = self.r[near], self.r[far]
        hidden = r1 @ self.c[0] + r2 @ self.c[1]
        log_k = np.log(NOISE * self.noise).astype(np.float32)
        q_real, q_noise = self.q[target], self.q[noise]
        real = (hidden * q_real).sum(axis=1) + self.b[target] - log_k[target]
        fake = hidden @ q_noise.T + self.b[noise] - log_k[noise]
        # Derivatives of the log-likelihood that real tokens are real and noise is noise.
        g_real = 1.0 / (1.0 + np.exp(np.clip(real, -30, 30)))
        g_fake = -1.0 / (1.0 + np.exp(-np.clip(fake, -30, 30)))
        g_hidden = g_real[:, None] * q_real + g_fake @ q_noise
        self._climb("c", 0.2 * rate, np.stack([r1.T @ g_hidden, r2.T @ g_hidden]))
        d_r = _sums(near, g_hidden @ self.c[0].T) + _sums(far, g_hidden @ self.c[1].T)
        d_q = _sums(target, g_real[:, None] * hidden)
        np.add.at(d_q, noise, g_fake.T @ hidden)
        d_b = np.bincount(target, weights=g_real, minlength=CLASSES) + np.bincount(
            noise, weights=g_fake.sum(axis=0), minlength=CLASSES)
        self._climb("r", rate, d_r)
        self._climb("q", rate, d_q)
        self._climb("b", 0.2 * rate, d_b.astype(np.float32))

    def _climb(self, name: str, rate: float, gradient: np.ndarray) -> None:
        """Adagrad: steps shrink with the squares of the gradients that this task has seen."""
        seen = self.squares.setdefault(name, np.full(gradient.shape, 1.0, dtype=np.float32))
        seen += gradient * gradient
        parameter = getattr(self, name)
        parameter += np.float32(rate) * gradient / np.sqrt(seen)

    def train(self, ids: np.ndarray, rng, rate: float = RATE) -> None:
        """`ids`: classes of whole texts one after the other, each with its end token."""
        near, far = _contexts(ids)
        order = rng.permutation(len(ids))
        for at in range(0, len(ids), BATCH):
            some = order[at:at + BATCH]
            self.step(near[some], far[some], ids[some], rng, rate * len(some) / BATCH)

    def normalisers(self) -> np.ndarray:
        """log of the summed exponentials for every context, `[near, far]`."""
        one, two = self.r @ self.c[0], self.r @ self.c[1]
        out = np.empty((CLASSES, CLASSES), dtype=np.float32)
        for near in range(CLASSES):
            scores = (one[near] + two) @ self.q.T + self.b
            top = scores.max(axis=1, keepdims=True)
            out[near] = (top + np.log(np.exp(scores - top).sum(axis=1, keepdims=True)))[:, 0]
        return out

    def log_probabilities(self, ids: np.ndarray, normalisers: np.ndarray) -> np.ndarray:
        """Natural log of `P(class | context)` of each token."""
        near, far = _contexts(ids)
        one, two = self.r @ self.c[0], self.r @ self.c[1]
        scores = ((one[near] + two[far]) * self.q[ids]).sum(axis=1) + self.b[ids]
        return scores.astype(np.float64) - normalisers[near, far]


def _sums(index: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of the rows of each class."""
    flat = (index[:, None] * WIDTH + np.arange(WIDTH)).ravel()
    return np.bincount(flat, weights=rows.ravel(), minlength=CLASSES * WIDTH).reshape(CLASSES, WIDTH).astype(np.float32)


def _contexts(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two classes before each token; the end token (class 0) stands before the first word."""
    near = np.concatenate(([0], ids[:-1]))
    far = np.concatenate(([0, 0], ids[:-2]))[:len(ids)]
    return near, np.where(near == 0, 0, far)


def train_model(rows: DataFrame, counts: Counts, rounds: int = ROUNDS) -> Model:
    """Data-parallel training; `rows` holds `doc_id` and `text`."""
    own, class_tokens = counts.own, counts.class_tokens
    model = Model(class_tokens)
    dealt = rows.withColumn("turn", F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(rounds)))
    for turn in range(rounds):
        start = model.vector()

        def run(batches):
            mine = Model(class_tokens, start)
            rng = np.random.default_rng([SEED, turn, TaskContext.get().partitionId()])
            class_of = _Classes(own).__getitem__
            held: list[int] = []
            tokens = 0
            for b in batches:
                for t in b["text"]:
                    held += map(class_of, words_of(t))
                    if len(held) >= 50 * BATCH:
                        mine.train(np.array(held), rng)
                        tokens += len(held)
                        held = []
            if held:
                mine.train(np.array(held), rng)
                tokens += len(held)
            yield {"tokens": [tokens], "values": [mine.vector().astype(np.float64) * tokens]}

        parts = map_batches(dealt.filter(F.col("turn") == turn).select("text"), run, "tokens long, values array<double>")
        sums = parts.select("tokens", F.posexplode("values").alias("i", "v")).groupBy("i").agg(
            F.sum("v").alias("v"), F.sum("tokens").alias("n")).toArrow()  # one row a parameter
        if sums.num_rows and sums.column("n")[0].as_py():
            new = np.empty(len(start))
            new[sums.column("i").to_numpy()] = sums.column("v").to_numpy() / sums.column("n").to_numpy()
            model = Model(class_tokens, new)
    return model


# Scoring ----------------------------------------------------------------------------------------


def score_texts(docs: DataFrame, held_out_fold: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Learn from rows outside the held-out fold and score all rows: `OUTPUT`."""
    texts = texts_of(docs, key, text)
    held_out = fold("doc_id") == held_out_fold
    learning = texts.filter(~held_out)
    table = count_words(learning)
    counts = Counts(table)
    model = train_model(learning, counts)
    log_total = float(np.log10(counts.tokens + 0.5 * (counts.distinct + 1)))
    shared = np.log10(counts.class_tokens + 0.5 * (counts.class_distinct + 1))
    send = texts.sparkSession.sparkContext.broadcast(
        (model, model.normalisers(), counts.own, counts.frequent, shared))

    def run(batches):
        model, normalisers, own, frequent, shared = send.value
        place = {w: i for i, w in enumerate(frequent)}
        log_count = np.log10(np.fromiter(frequent.values(), float, len(frequent)) + 0.5)
        cls = np.array([own[w] if w in own else shared_class(w) for w in frequent], dtype=np.int64)
        get, absent = place.get, len(place)
        log_count, cls = np.append(log_count, 0.0), np.append(cls, 0)
        next_row = TaskContext.get().partitionId() << 33

        def out(keys, texts, first):
            """Rows of texts, then rows of their words that are not frequent."""
            words = [w for t in texts for w in t]
            at = np.fromiter(map(get, words, repeat(absent)), dtype=np.int64, count=len(words))
            ids = cls[at]
            rare = np.flatnonzero(at == absent)
            ids[rare] = [own[w] if w in own else shared_class(w) for w in map(words.__getitem__, rare.tolist())]
            size = np.array([len(t) for t in texts])
            start = np.concatenate(([0], np.cumsum(size)[:-1]))
            logs = model.log_probabilities(ids, normalisers) / np.log(10.0)
            # A word that is a class of its own has probability 1 in it.
            logs += np.where(ids < OWN, 0.0, log_count[at] - shared[ids])
            counts = Counter(zip(np.repeat(np.arange(len(texts)), size)[rare].tolist(), map(words.__getitem__, rare.tolist())))
            n, m = len(texts), len(counts)
            none = [None] * m
            return {
                "row": [*range(first, first + n), *(first + d for d, _ in counts)],
                "doc_id": [k[0] for k in keys] + none, "held_out": [k[1] for k in keys] + none,
                "word": [None] * n + [w for _, w in counts], "n": [*size.tolist(), *counts.values()],
                # Of a rare word: whether it is a class of its own. Only the end token can be one.
                "known": [*np.add.reduceat(at < absent, start, dtype=np.int64).tolist(), *(int(w in own) for _, w in counts)],
                "base": [*(np.add.reduceat(log_count[at], start) - size * log_total).tolist(), *none],
                "score": [*np.add.reduceat(logs, start).tolist(), *none],
            }

        keys, texts, tokens = [], [], 0
        for b in batches:
            for doc_id, held, t in zip(b["doc_id"], b["held_out"], b["text"]):
                keys.append((doc_id, held))
                texts.append(words_of(t))
                tokens += len(texts[-1])
                if tokens >= 200_000:
                    yield out(keys, texts, next_row)
                    next_row += len(keys)
                    keys, texts, tokens = [], [], 0
        if keys:
            yield out(keys, texts, next_row)

    scored = materialize(map_batches(
        texts.withColumn("held_out", held_out), run,
        "row long, doc_id long, held_out boolean, word binary, n long, known long, base double, score double"), "scored")
    rare = scored.filter("word IS NOT NULL").select("row", "word", "n", "known").join(table.select("word", "c"), "word", "left")
    log_c = F.log10(F.coalesce("c", F.lit(0)) + 0.5) * F.col("n")
    rare = rare.groupBy("row").agg(
        F.sum(log_c).alias("rare_base"), F.sum(F.when(F.col("known") == 0, log_c).otherwise(0.0)).alias("rare_score"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"))
    rows = scored.filter("word IS NULL").join(rare, "row", "left")
    return rows.select(
        "doc_id", "held_out", F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(counts.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("rare_score", F.lit(0.0))).alias("score"),
    )
