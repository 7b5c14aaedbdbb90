"""Nearest neighbours by cosine: multiprobe p-stable hashing with exact reranking.

Vectors of length one are projected on Gaussian directions (2-stable); each table cuts `functions`
projections into cells of one width, and the cells together name a bucket. A query visits, in each
table, the buckets around its own in the order of their estimated success: the probability that a
neighbour at the expected distance falls into that combination of cells. Candidates of all tables
are merged and ranked by the exact cosine in double precision.

Rows of one bucket travel as blocks of bounded size, which tasks fill before the one shuffle, queries
of one bucket as well, and one row of the join is a block against a block, so no group is ever gathered
whole. Vectors keep the precision of their column, so single precision takes four bytes a component.
A task compares blocks in single precision, takes the exact cosine of what is within the bound of its
error, and hands on the best `k + 1` of each query. Identical vectors become one entry that keeps its
smallest ids: more than `k + 1` of them can't be among the `k` nearest.

A query with fewer than `k` found is compared with all vectors, block against block, so it gets all of
them where there are fewer than `k`. Each width of vectors is hashed and searched on its own.

A query becomes as many rows as it has probes, which the planner doesn't see: it would take the blocks
for as small as the queries and broadcast them through the driver. So the kind of that join is set.

Vectors that are null, zero, or that hold a null or non-finite component take no part. Repeated ids with different vectors are different
candidates; a query's own id is never its neighbour.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelflow.llm.common import arrow_type, map_batches, release, sliced
from labelflow.scale import materialize

TABLES, FUNCTIONS, WIDTH, PROBES = 6, 4, 1.4, 24
NEIGHBOUR_DISTANCE = 1.05  # expected distance of a neighbour between vectors of length one
SEED = 7
BLOCK, QUERY_BLOCK = 512, 512  # vectors in a block
CHUNK, CHUNK_BYTES = 1 << 17, 1 << 25  # vectors, and bytes of them, that a task deals to blocks at once
PAIR_BYTES = 1 << 23  # of blocks that a task reads at once
HELD = 1 << 20  # candidates that a task holds
OUTPUT = "query_id long, rank int, vec_id long, score double"

_CELL = 1 << 11  # cells of a projection lie within +-1024: |projection| < 1024 * WIDTH


class Hashing:
    """The tables' functions; all of them follow from the parameters and the seed."""

    def __init__(self, dim: int, tables: int = TABLES, functions: int = FUNCTIONS, width: float = WIDTH,
                 probes: int = PROBES, distance: float = NEIGHBOUR_DISTANCE, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.tables, self.functions, self.width, self.distance = tables, functions, width, distance
        self.directions = rng.standard_normal((tables, dim, functions))
        self.shifts = rng.uniform(0, width, (tables, functions))
        steps = np.indices((3,) * functions).reshape(functions, -1).T - 1
        self.steps = steps
        self.probes = min(probes, len(steps))
        self.radix = _CELL ** np.arange(functions, dtype=np.int64)

    def cells(self, unit: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        projected = unit @ self.directions[table] + self.shifts[table]
        cell = np.floor(projected / self.width).astype(np.int64)
        return cell, projected - cell * self.width

    def buckets(self, unit: np.ndarray, table: int) -> np.ndarray:
        return (self.cells(unit, table)[0] + _CELL // 2) @ self.radix

    def probed(self, unit: np.ndarray, table: int) -> np.ndarray:
        """Buckets to visit, a row for each query, the most promising first."""
        cell, inside = self.cells(unit, table)
        normal = np.vectorize(lambda z: 0.5 * (1.0 + math.erf(z / math.sqrt(2.0))))
        gains = []
        for step in (-1, 0, 1):
            low = (step * self.width - inside) / self.distance
            mass = normal(low + self.width / self.distance) - normal(low)
            gains.append(np.log(np.maximum(mass, 1e-12)))
        gain = np.stack(gains, axis=2)
        success = sum(gain[:, f, self.steps[:, f] + 1] for f in range(self.functions))
        order = np.argsort(-success, axis=1, kind="stable")[:, :self.probes]
        return ((cell + _CELL // 2) @ self.radix)[:, None] + (self.steps @ self.radix)[order]


def _matrix(rows: list[bytes], kind: str, dim: int) -> np.ndarray:
    """Rows, or blocks of them, as doubles."""
    return np.frombuffer(b"".join(rows), dtype=kind).reshape(-1, dim).astype("<f8")


def _scaled(m: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that products of huge or tiny components stay finite."""
    _, exponent = np.frexp(np.abs(m).max(axis=1, keepdims=True))
    return np.ldexp(m, -exponent)


def _lengths(m: np.ndarray) -> np.ndarray:
    return np.sqrt((m * m).sum(axis=1))


def _unit(m: np.ndarray) -> np.ndarray:
    m = _scaled(m)
    return m / _lengths(m)[:, None]


def _kind(vectors: DataFrame, vector: str) -> str:
    """The precision in which vectors travel: single if their column has no more."""
    return "<f4" if vectors.select(vector).dtypes[0][1] == "array<float>" else "<f8"


def valid_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
                  dim: int | None = None) -> DataFrame:
    """`(vec_id, vec, h)`: the rows that take part, their vectors as bytes of `_kind`, and a hash."""
    kind = _kind(vectors, vector)
    wide = F.col(vector).cast("array<float>" if kind == "<f4" else "array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), wide.alias("wide"))
    schema = arrow_type("vec_id long, vec binary")

    def run(batches):
        try:
            for b in sliced(batches, PAIR_BYTES):
                ids, wide = b.column("vec_id"), b.column("wide")
                size = pc.fill_null(pc.list_value_length(wide), 0).to_numpy()
                begin = np.cumsum(size) - size
                parts = pc.list_flatten(wide).to_numpy(zero_copy_only=False)  # null is NaN
                known = pc.is_valid(ids).to_numpy(zero_copy_only=False) & (size > 0)
                for n in np.unique(size[known]).tolist() if dim is None else [dim]:
                    at = np.flatnonzero(known & (size == n))
                    m = parts[begin[at][:, None] + np.arange(n)].astype(kind) + 0  # one form of zero
                    good = np.isfinite(m).all(axis=1) & m.any(axis=1)
                    if good.any():
                        yield pa.RecordBatch.from_arrays([ids.take(pa.array(at[good])), _binary(m[good])], schema=schema)
        finally:
            release()

    return rows.mapInArrow(run, "vec_id long, vec binary").withColumn("h", F.xxhash64("vec"))


def _binary(m: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    m = np.ascontiguousarray(m)
    ends = np.arange(len(m) + 1, dtype="<i4") * (m.itemsize * m.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(m), [None, pa.py_buffer(ends), pa.py_buffer(m)])


def entries(vectors: DataFrame, k: int) -> DataFrame:
    """`(id, h, vec, ids)`: distinct vectors with their `k + 1` smallest ids; `id` is the smallest.

    Ids beyond `k + 1` of a vector drop out before the shuffle, so a vector that a third of the rows
    share costs a few rows a task.
    """
    first = W.partitionBy("h", "vec").orderBy("vec_id")
    few = vectors.withColumn("r", F.dense_rank().over(first)).filter(F.col("r") <= k + 1)
    grouped = few.groupBy("h", "vec").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))
    return grouped.select(F.col("ids")[0].alias("id"), "h", "vec", "ids")


_BLOCK = "tab int, bucket long, {0}_ids binary, {0}_vecs binary"


class _Dealer:
    """Vectors of a task, dealt to blocks `(tab, bucket, ids, vecs)` of at most `size` of one bucket."""

    def __init__(self, name: str, size: int, chunk: int):
        self.columns, self.size, self.chunk = (f"{name}_ids", f"{name}_vecs"), size, chunk
        self.held, self.n, self.bytes = [], 0, 0

    def add(self, batch: dict, buckets: list[np.ndarray]):
        """`buckets`: of each table, a row for each vector."""
        vecs = np.frombuffer(b"".join(batch["vec"]), np.uint8).reshape(len(batch["vec"]), -1)
        self.held.append((_keys(batch), vecs, *buckets))
        self.n, self.bytes = self.n + len(vecs), self.bytes + vecs.nbytes
        if self.n >= self.chunk or self.bytes >= CHUNK_BYTES:
            yield from self.close()

    def close(self):
        if not self.held:
            return
        keys, vecs, *tables = (np.concatenate(x) for x in zip(*self.held))
        self.held, self.n, self.bytes = [], 0, 0
        for t, buckets in enumerate(tables):
            flat, per = buckets.ravel(), buckets.shape[1]
            order = np.argsort(flat, kind="stable")
            flat, rows = flat[order], order // per
            first = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
            cuts = np.concatenate([np.arange(i, j, self.size) for i, j in zip(first, np.append(first[1:], len(flat)))])
            ends = np.append(cuts[1:], len(flat))
            for at in range(0, len(cuts), 64):
                blocks = [rows[i:j] for i, j in zip(cuts[at:at + 64], ends[at:at + 64])]
                yield {"tab": [t] * len(blocks), "bucket": flat[cuts[at:at + 64]],
                       self.columns[0]: [keys[r].tobytes() for r in blocks], self.columns[1]: [vecs[r].tobytes() for r in blocks]}


def _keys(batch: dict) -> np.ndarray:
    return np.array([batch["id"], batch["h"]], dtype="<i8").T


class _Block:
    """Vectors of a block: scaled, their lengths, and rounded ones of length one."""

    def __init__(self, keys: np.ndarray, m: np.ndarray, length: np.ndarray, rounded: np.ndarray):
        self.keys, self.m, self.length, self.rounded = keys, m, length, rounded

    @classmethod
    def read(cls, ids: bytes, vecs: bytes, kind: str, dim: int) -> _Block:
        m = _scaled(_matrix([vecs], kind, dim))
        length = _lengths(m)
        return cls(np.frombuffer(ids, "<i8").reshape(-1, 2), m, length, (m / length[:, None]).astype(np.float32))

    @classmethod
    def joined(cls, blocks: list[_Block]) -> _Block:
        parts = zip(*((b.keys, b.m, b.length, b.rounded) for b in blocks))
        return blocks[0] if len(blocks) == 1 else cls(*(np.concatenate(x) for x in parts))


class _Best:
    """The `k + 1` nearest seen of each query, by exact cosine, then by id; one of them may be the query itself.

    What is held is cut to them now and then, and handed on if there are too many queries.
    """

    def __init__(self, k: int, dim: int, room: int):
        self.keep, self.dim, self.room = k + 1, dim, room
        self.slack = 2.4e-7 * (dim + 8)  # twice what a cosine in single precision can be off
        self.held = np.empty((0, 3), np.int64)  # query, id, h
        self.score = np.empty(0)
        self.new, self.count = [], 0
        self.least = {}  # of a query, the cosine of the last that was held

    def block(self, queries: _Block, base: _Block):
        rough = queries.rounded @ base.rounded.T
        known = np.array([self.least.get(q, -2.0) for q in queries.keys[:, 0].tolist()])
        least = (known - self.slack).astype(np.float32)
        hits = np.flatnonzero(rough >= least[:, None])
        many = np.flatnonzero(np.bincount(hits // len(base.keys), minlength=len(queries.keys)) > 2 * self.keep)
        if len(many):  # only of these, the best of the block itself are looked for
            own = np.partition(rough[many], len(base.keys) - self.keep, axis=1)[:, len(base.keys) - self.keep]
            least[many] = np.maximum(least[many], own - np.float32(self.slack))
            hits = np.flatnonzero(rough >= least[:, None])
        step = max(1, (1 << 21) // self.dim)
        for at in range(0, len(hits), step):
            q, c = np.divmod(hits[at:at + step], len(base.keys))
            score = (queries.m[q] * base.m[c]).sum(axis=1) / (queries.length[q] * base.length[c])
            near = score >= known[q]
            rows = np.column_stack([queries.keys[q, 0], base.keys[c]])[near]
            rows, score = self.cut(rows, score[near]) if len(rows) > self.room // 16 else (rows, score[near])
            self.new.append((rows, score))
            self.count += len(rows)

    def out(self, end: bool = False):
        """What leaves the task now, as rows of `_NEAR`: nothing while there is room, all at the end."""
        if self.count < self.room // 4 and not end:
            return
        rows, score = self.cut(*(np.concatenate(x) for x in zip((self.held, self.score), *self.new)))
        last = np.flatnonzero(np.append(rows[1:, 0] != rows[:-1, 0], True)[:len(rows)])
        full = np.diff(last, prepend=-1) == self.keep
        self.least = dict(zip(rows[last[full], 0].tolist(), score[last[full]].tolist()))
        self.held, self.score, self.new, self.count = rows, score, [], 0
        if len(rows) >= self.room or end:
            for at in range(0, len(rows), 1 << 16):
                some = rows[at:at + (1 << 16)]
                yield {"query": some[:, 0], "id": some[:, 1], "h": some[:, 2], "score": score[at:at + (1 << 16)]}
            self.held, self.score = rows[:0], score[:0]

    def cut(self, rows: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first `k + 1` of each query, an entry once, however many tables it was found in."""
        order = np.lexsort((-score, rows[:, 2], rows[:, 1], rows[:, 0]))
        rows, score = rows[order], score[order]
        once = np.append(True, (rows[1:] != rows[:-1]).any(axis=1))[:len(rows)]
        rows, score = rows[once], score[once]
        order = np.lexsort((rows[:, 2], rows[:, 1], -score, rows[:, 0]))
        rows, score = rows[order], score[order]
        first = np.arange(len(rows)) - np.searchsorted(rows[:, 0], rows[:, 0]) < self.keep
        return rows[first], score[first]


_NEAR = "query long, id long, h long, score double"


def _compared(pairs: DataFrame, k: int, kind: str, dim: int) -> DataFrame:
    """Pairs of blocks to `_NEAR`: of each query, the `k + 1` nearest that a task has seen."""
    def rank(batches):
        best, base_ids, base = _Best(k, dim, HELD), None, None
        read, size = {}, 0  # blocks of queries that were read, by their ids: each block of a bucket meets them all

        def queries_of(ids, vecs):
            nonlocal size
            if ids not in read:
                if size > PAIR_BYTES:
                    read.clear()
                    size = 0
                read[ids], size = _Block.read(ids, vecs, kind, dim), size + len(vecs)
            return read[ids]

        for b in batches:
            at, total = 0, len(b["base_ids"])
            while at < total:  # blocks of queries that meet the same block are taken together
                end, n = at + 1, len(b["query_ids"][at])
                while end < total and n < 16 * QUERY_BLOCK and b["base_ids"][end] == b["base_ids"][at]:
                    end, n = end + 1, n + len(b["query_ids"][end])
                if b["base_ids"][at] != base_ids:
                    base_ids = b["base_ids"][at]
                    base = _Block.read(base_ids, b["base_vecs"][at], kind, dim)
                best.block(_Block.joined([queries_of(b["query_ids"][i], b["query_vecs"][i]) for i in range(at, end)]), base)
                yield from best.out()
                at = end
        yield from best.out(end=True)

    return map_batches(pairs.select("base_ids", "base_vecs", "query_ids", "query_vecs"), rank, _NEAR, PAIR_BYTES)


def search(vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding",
           dim: int | None = None, **hashing) -> DataFrame:
    """The `k` nearest found of each query row, as `OUTPUT`; ties go to the smaller id.

    `is_query` chooses among the rows of `vectors`. Vectors are compared with those of their own
    width, each width is searched on its own; `dim` asks for one width only.
    """
    if dim is None:
        sizes = valid_vectors(vectors, key, vector).select(
            (F.octet_length("vec") / np.dtype(_kind(vectors, vector)).itemsize).cast("int").alias("dim"))
        widths = [r.dim for r in sizes.groupBy("dim").count().orderBy("dim").collect()]  # a row a width
    else:
        widths = [dim]
    found = [_search_width(vectors, is_query, k, key, vector, w, **hashing) for w in widths]
    return reduce(DataFrame.unionAll, found) if found else vectors.sparkSession.createDataFrame([], OUTPUT)


def _search_width(vectors: DataFrame, is_query: Column, k: int, key: str, vector: str, dim: int, **hashing) -> DataFrame:
    tables, kind = Hashing(dim, **hashing), _kind(vectors, vector)

    def hashed(batches):
        dealer = _Dealer("base", BLOCK, CHUNK)
        for b in batches:
            unit = _unit(_matrix(b["vec"], kind, dim))
            yield from dealer.add(b, [tables.buckets(unit, t)[:, None] for t in range(tables.tables)])
        yield from dealer.close()

    def probing(batches):
        dealer = _Dealer("query", QUERY_BLOCK, CHUNK)
        for b in batches:
            for at in range(0, len(b["vec"]), 256):
                some = {c: b[c][at:at + 256] for c in b}
                unit = _unit(_matrix(some["vec"], kind, dim))
                yield from dealer.add(some, [tables.probed(unit, t) for t in range(tables.tables)])
        yield from dealer.close()

    known = materialize(entries(valid_vectors(vectors, key, vector, dim), k), "entries")
    asked = materialize(
        valid_vectors(vectors.filter(is_query), key, vector, dim).distinct().withColumnRenamed("vec_id", "query_id"),
        "queries")
    # A vector is looked for once, however many query rows share it.
    wanted = asked.groupBy("h", "vec").agg(F.min("query_id").alias("id"))
    # A task that hashes several parts of the table has more of each bucket, so blocks are fuller.
    parts = max(vectors.sparkSession.sparkContext.defaultParallelism, math.ceil(known.rdd.getNumPartitions() / 4))
    base = map_batches(known.select("id", "h", "vec").coalesce(parts), hashed, _BLOCK.format("base"), PAIR_BYTES)
    probe = map_batches(wanted.select("id", "h", "vec"), probing, _BLOCK.format("query"), PAIR_BYTES)
    near = _compared(base.join(probe.hint("merge"), ["tab", "bucket"]), k, kind, dim)
    names = asked.join(wanted.select(F.col("id").alias("query"), "h", "vec"), ["h", "vec"]).select("query_id", "query")
    ranks = materialize(_ranked(near, names, known, k), "ranks")
    # Queries with fewer than k found are compared with all vectors, block against block.
    full = ranks.groupBy("query_id").count().filter(F.col("count") >= k)
    short = materialize(names.join(full, "query_id", "left_anti"), "short-queries")
    if short.isEmpty():
        return ranks
    lacking = wanted.join(short.select(F.col("query").alias("id")).distinct(), "id", "left_semi")
    blocks = _plain_blocks(known, BLOCK, "base").crossJoin(_plain_blocks(lacking, QUERY_BLOCK, "query"))
    scanned = _compared(blocks, k, kind, dim)
    return ranks.join(full, "query_id", "left_semi").unionAll(_ranked(scanned, short, known, k))


def _ranked(near: DataFrame, names: DataFrame, known: DataFrame, k: int) -> DataFrame:
    """`OUTPUT` of the queries `(query_id, query)` from candidates `(query, id, h, score)`.

    `query` is the smallest id of a query vector; ids that repeat with other vectors are told apart by it.
    """
    merged = near.groupBy("query", "id", "h").agg(F.max("score").alias("score"))
    best = W.partitionBy("query").orderBy(F.desc("score"), "id", "h")
    few = merged.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1).drop("r")
    named = few.join(known.select("id", "h", "ids"), ["id", "h"])
    own = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # Ids are laid out after the join, so that the planner knows how large its sides are.
    expanded = names.join(named, "query").select("query_id", "score", F.explode("ids").alias("vec_id"))
    found = expanded.filter(F.col("vec_id") != F.col("query_id"))
    ranks = found.withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= k)
    return ranks.select("query_id", "rank", "vec_id", "score")


def _plain_blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Rows `(id, h, vec)` as blocks of at most `size` vectors, as each task reads them."""
    def run(batches):
        for b in batches:
            for at in range(0, len(b["id"]), size):
                some = {c: b[c][at:at + size] for c in b}
                yield {f"{name}_ids": [_keys(some).tobytes()], f"{name}_vecs": [b"".join(some["vec"])]}

    return map_batches(rows.select("id", "h", "vec"), run, f"{name}_ids binary, {name}_vecs binary", PAIR_BYTES)
