"""Embedding whitening on a distributed BlockMatrix.

Entries become whole numbers `x = floor(1024 c) + 100000`. Each task writes blocks of whole rows, about
`BLOCK_ENTRIES` numbers each, and counts per partition number the blocks through. The sums of all rows
give the exact mean; the centred rows `(n x - S) / n` are the blocks of an MLlib `BlockMatrix`. The
transposed matrix times the matrix is the scatter matrix, as wide as one vector: its middle
dimension is split, so tasks add up partial products of a bounded number of rows each. `eigh` takes
that one matrix apart on the driver, and a second product, with the leading unit eigenvectors
divided by the square roots of their eigenvalues, projects all rows.

A component without variance can't be scaled: its `whitened` is null and it has no part in
`identity_error`, which is null if no component has variance. Vectors that are null, empty, hold null
or non-finite entries, or entries of `LARGEST` or more, take no part. Vectors of different widths can't
share a covariance: each width is a table of its own, with its own `n`. `deviation` is exact; where it
doesn't fit a long, it is null. Repeated rows and repeated or null ids give rows each; an empty
table gives none; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelflow.llm.common import arrow_type
from labelflow.scale import materialize

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
BLOCK_ENTRIES = 1 << 16
LARGEST = float(1 << 30)  # entries from here on count as non-finite
NO_VARIANCE = 1e-12  # share of the trace up to which a component has none
OUTPUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")
_BLOCKS = "part int, place int, ids array<long>, x binary"


def whole_numbers(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """`(vec_id, width, x)` of the vectors that take part."""
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("c"))
    finite = F.forall("c", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < LARGEST))
    return rows.filter(F.col("c").isNotNull() & (F.size("c") > 0) & finite).select(
        "vec_id", F.size("c").alias("width"), F.transform("c", lambda e: F.floor(e * SCALE) + SHIFT).alias("x"))


class Blocks:
    """Written blocks of whole rows, numbered through, and the exact sums of all rows."""

    def __init__(self, rows: DataFrame, width: int):
        self.width, self.height = width, max(1, BLOCK_ENTRIES // width)
        self.table = materialize(_in_blocks(rows, width, self.height), "blocks")
        # A row a partition, and a row a dimension.
        parts = self.table.groupBy("part").agg(F.count(F.lit(1)).alias("b"), F.sum(F.size("ids")).alias("n"))
        firsts, self.number, self.n = [], 0, 0
        for r in parts.orderBy("part").collect():
            firsts.append((r.part, self.number))
            self.number, self.n = self.number + r.b, self.n + r.n
        self.sums = _sums(self.table, width)
        firsts = F.broadcast(rows.sparkSession.createDataFrame(firsts, "part int, first int"))
        self.numbered = self.table.join(firsts, "part").select((F.col("first") + F.col("place")).alias("block"), "ids", "x")

    def matrix(self) -> BlockMatrix:
        """The centred rows; rows of zeros, which add nothing to a product, fill the blocks up."""
        n, sums, width, height = self.n, self.sums, self.width, self.height

        def block(row) -> tuple[tuple[int, int], DenseMatrix]:
            rows = np.zeros((height, width))
            rows[:len(row.ids)] = from_mean(row.x, n, sums).astype(np.float64) / n
            return (row.block, 0), DenseMatrix(height, width, rows.ravel(), isTransposed=True)

        blocks = self.numbered.rdd.map(block)
        return BlockMatrix(blocks, height, width, self.number * height, width)

    def deviations(self) -> DataFrame:
        """`(block, ids, deviations)`, in the order of the rows."""
        n, sums = self.n, self.sums
        schema = arrow_type("block int, ids array<long>, deviations array<long>")

        def run(batches):
            for b in batches:
                found = []
                for x in b.column(2).to_pylist():
                    d = from_mean(x, n, sums)
                    if d.dtype == object or float(np.abs(d).max(initial=0)) ** 2 * d.shape[1] >= 2.0**62:
                        d = d.astype(object)
                    found.append([int(v) if v < 1 << 63 else None for v in (d * d).sum(axis=1)])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1).cast(schema.field(1).type), pa.array(found, schema.field(2).type)],
                    schema=schema)

        return self.numbered.mapInArrow(run, "block int, ids array<long>, deviations array<long>")


def from_mean(x: bytes, n: int, sums: list[int]) -> np.ndarray:
    """`n x - S` of the rows of a block, exactly: as int64 where that holds them, else as Python integers."""
    rows = np.frombuffer(x, dtype="<i8").reshape(-1, len(sums))
    largest = max(int(np.abs(rows).max(initial=0)) * n, *(abs(s) for s in sums))
    if largest < 1 << 62:
        return rows * n - np.array(sums, dtype=np.int64)
    return rows.astype(object) * n - np.array(sums, dtype=object)


def _in_blocks(rows: DataFrame, width: int, height: int) -> DataFrame:
    schema = arrow_type(_BLOCKS)

    def run(batches):
        part, place = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        held = np.empty((0, width), dtype="<i8")

        def block(ids, x):
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([place], pa.int32()),
                pa.array([ids], schema.field(2).type), pa.array([x.tobytes()], pa.binary())], schema=schema)

        for b in batches:
            ids += b.column(0).to_pylist()
            held = np.concatenate([held, b.column(1).flatten().to_numpy().reshape(-1, width)])
            while len(ids) >= height:
                yield block(ids[:height], held[:height])
                place += 1
                ids, held = ids[height:], held[height:]
        if ids:
            yield block(ids, held)

    return rows.select("vec_id", "x").mapInArrow(run, _BLOCKS)


def _sums(blocks: DataFrame, width: int) -> list[int]:
    """The exact sum of each dimension: each block first, then all of them."""
    schema = arrow_type("s array<long>")

    def run(batches):
        for b in batches:
            sums = [np.frombuffer(x, dtype="<i8").reshape(-1, width).sum(axis=0) for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(sums, schema.field(0).type)], schema=schema)

    each = blocks.select("x").mapInArrow(run, "s array<long>").select(F.posexplode("s").alias("place", "s"))
    total = each.groupBy("place").agg(F.sum(F.col("s").cast("decimal(20,0)")).alias("s"))
    return [int(r.s) for r in total.orderBy("place").collect()]


def scatter(centred: BlockMatrix, rows: int, height: int) -> np.ndarray:
    """Transposed matrix times the matrix.

    All rows meet in one result block, so the middle dimension is split: each split holds at least as
    many rows as a vector is wide, so the partial products are no larger than the rows themselves.
    The JVM's `multiply` takes the number of splits; Python's has no such argument.
    """
    width = centred.numCols()
    splits = max(1, rows // max(height, width))
    wrapped = centred.transpose()._java_matrix_wrapper
    product = wrapped.call("multiply", centred._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, width, width).toLocalMatrix().toArray()


def whiten_width(rows: DataFrame, width: int, components: int = COMPONENTS) -> DataFrame:
    """`OUTPUT` for rows `(vec_id, x)` of one width; there must be at least one row."""
    spark = rows.sparkSession
    blocks = Blocks(rows, width)
    centred = blocks.matrix()
    covariance = scatter(centred, blocks.number * blocks.height, blocks.height) / blocks.n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    k = min(components, width)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    trace = float(np.trace(covariance))
    varies = values > NO_VARIANCE * trace
    whitening = np.where(varies, vectors / np.sqrt(np.where(varies, values, 1.0)), 0.0)
    single = spark.sparkContext.parallelize([((0, 0), DenseMatrix(width, k, whitening.ravel(order="F")))], 1)
    projected = centred.multiply(BlockMatrix(single, width, k, width, k))

    def of_block(entry):
        (block, _), matrix = entry
        return int(block), matrix.toArray().tolist()

    whitened = spark.createDataFrame(projected.blocks.map(of_block), "block int, y array<array<double>>")
    # Without the rows that filled the blocks up.
    both = whitened.join(blocks.deviations(), "block").withColumn("y", F.slice("y", F.lit(1), F.size("ids")))
    each = materialize(both.select(F.inline(F.arrays_zip("ids", "deviations", "y"))), "whitened")
    error = identity_error(each, [i for i in range(k) if varies[i]])
    share = [float(max(v, 0.0) / trace) if trace else 0.0 for v in values]
    keeps = [bool(v) for v in varies]
    component = F.col("at") + 1
    return each.select("ids", "deviations", F.posexplode("y").alias("at", "w")).select(
        F.col("ids").alias("vec_id"), component.cast("int").alias("component"),
        F.lit(blocks.n).cast("long").alias("n"), F.col("deviations").alias("deviation"),
        F.when(F.element_at(F.lit(keeps), component), F.col("w")).alias("whitened"),
        F.element_at(F.lit(share), component).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))


def identity_error(rows: DataFrame, components: list[int]) -> float | None:
    """Largest absolute entry of the covariance of the whitened rows minus the identity."""
    pairs = [(i, j) for i in components for j in components if i <= j]
    if not pairs:
        return None
    found = rows.agg(*[F.covar_pop(F.col("y")[i], F.col("y")[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs))


def whiten(vectors: DataFrame, components: int = COMPONENTS, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per vector that takes part and component, numbered from 1 by falling variance."""
    rows = whole_numbers(vectors, key, vector)
    widths = [r.width for r in rows.groupBy("width").count().orderBy("width").collect()]  # a row a width
    of_widths = [whiten_width(rows.filter(F.col("width") == w), w, components) for w in widths]
    return reduce(DataFrame.unionByName, of_widths) if of_widths else vectors.sparkSession.createDataFrame([], OUTPUT)
