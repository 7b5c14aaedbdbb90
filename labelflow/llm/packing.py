"""Packing by optimal length buckets.

Every row's length is counted, the lengths of all rows make one global histogram, and dynamic
programming chooses the bucket bounds that minimise padding: a row is padded to the bound of its
bucket, the largest length in it. Inside a bucket, batches take as many rows as fit the token
budget; a row longer than the budget is a batch of its own, whole.

A bucket is dealt to chunks of a bounded expected size, by a hash of the row's place in a written
table, so no bucket and no repeated key is ordered in one task. Batches fill up inside a chunk: at
most one batch of a chunk is not full. Null and empty texts have length 1, the end token.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelflow.scale import materialize

BUCKETS, TOKEN_BUDGET = 16, 65_536
CHUNK_ROWS, CHUNK_BATCHES = 20_000, 16  # a chunk has as many rows as the larger of both asks for
# Distinct lengths, not rows: n of them need n * n / 2 tokens of text.
MAX_LENGTHS = 5_000_000
OUTPUT = ("doc_id long, n_tokens long, bucket int, bound long, chunk long, batch long, slot int, "
          "batch_rows int, padding long")


def words_and_end(text: Column) -> Column:
    """Number of words (runs of anything but ASCII white space) and one end token."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long") + 1


def optimal_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most `buckets` buckets with the least total padding.

    `lengths` are distinct and ascending. best[j] is the least padding of the first j lengths in so
    many buckets; a bucket of lengths i..j costs lengths[j] * rows - tokens. As a function of the
    bound these costs are lines with falling slopes, so one pass over a lower hull per bucket finds
    every best[j]; equal costs take the earlier border.
    """
    n = len(lengths)
    if n <= buckets:
        return [int(x) for x in lengths]
    size = [int(x) for x in lengths]
    rows = [0, *np.cumsum(counts, dtype=object).tolist()]
    tokens = [0, *np.cumsum(np.array(size, dtype=object) * counts.astype(object)).tolist()]
    best = [0] + [size[j] * rows[j + 1] - tokens[j + 1] for j in range(n)]
    borders: list[list[int]] = []
    for used in range(1, buckets):
        came = [0] * (n + 1)
        new = [0] * (n + 1)
        hull: list[tuple[int, int, int]] = []  # slope, value at 0, border; steeper ones last
        front = 0
        for j in range(1, n + 1):
            i = j - 1
            slope, value = -rows[i], best[i] + tokens[i]
            while len(hull) - front >= 2:
                (s1, v1, _), (s2, v2, _) = hull[-2], hull[-1]
                if (value - v1) * (s1 - s2) <= (v2 - v1) * (s1 - slope):
                    hull.pop()
                else:
                    break
            hull.append((slope, value, i))
            x = size[j - 1]
            while len(hull) - front >= 2 and hull[front + 1][0] * x + hull[front + 1][1] < hull[front][0] * x + hull[front][1]:
                front += 1
            s, v, border = hull[front]
            new[j] = s * x + v + x * rows[j] - tokens[j]
            came[j] = border
        best = new
        borders.append(came)
    bounds, j = [], n
    for came in reversed(borders):
        bounds.append(size[j - 1])
        j = came[j]
        if j == 0:
            break
    else:
        bounds.append(size[j - 1])
    return sorted(set(bounds))


def pack(docs: DataFrame, buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """One row per row of `docs`, as `OUTPUT`; `(bucket, chunk, batch)` names a batch."""
    spark = docs.sparkSession
    narrow = docs.select(
        F.col(key).cast("long").alias("doc_id"), words_and_end(F.col(text)).alias("n_tokens"),
        F.monotonically_increasing_id().alias("row"),
    )
    # Written once: the text is read once, and the row numbers can't change when a task is repeated.
    lengths = materialize(narrow, "lengths")
    histogram = lengths.groupBy("n_tokens").count().orderBy("n_tokens").take(MAX_LENGTHS + 1)
    if len(histogram) > MAX_LENGTHS:
        raise ValueError(f"more than {MAX_LENGTHS} distinct lengths")
    if not histogram:
        return spark.createDataFrame([], OUTPUT)
    sizes = np.array([r.n_tokens for r in histogram], dtype=np.int64)
    counts = np.array([r["count"] for r in histogram], dtype=np.int64)
    bounds = optimal_bounds(sizes, counts, buckets)
    edges = np.searchsorted(sizes, bounds, side="right")
    totals = np.diff(np.concatenate(([0], np.concatenate(([0], np.cumsum(counts)))[edges])))
    fits = [max(1, token_budget // b) for b in bounds]
    chunks = [max(1, int(t) // max(CHUNK_ROWS, CHUNK_BATCHES * f)) for t, f in zip(totals, fits)]

    def of_bucket(values) -> Column:
        return F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), F.col("bucket") + 1)

    bucket = sum((F.col("n_tokens") > b).cast("int") for b in bounds[:-1]) if len(bounds) > 1 else F.lit(0)
    placed = (
        lengths.withColumn("bucket", bucket)
        .withColumn("bound", of_bucket(bounds))
        .withColumn("chunk", F.pmod(F.xxhash64("row"), of_bucket(chunks)))
    )
    in_chunk = W.partitionBy("bucket", "chunk")
    fit = of_bucket(fits)
    place = F.row_number().over(in_chunk.orderBy("doc_id", "row")).cast("long") - 1
    ordered = placed.withColumn("place", place).withColumn("rows", F.count(F.lit(1)).over(in_chunk))
    return ordered.select(
        "doc_id", "n_tokens", "bucket", "bound", "chunk",
        F.floor(F.col("place") / fit).cast("long").alias("batch"),
        (F.col("place") % fit).cast("int").alias("slot"),
        F.least(fit, F.col("rows") - F.floor(F.col("place") / fit) * fit).cast("int").alias("batch_rows"),
        (F.col("bound") - F.col("n_tokens")).alias("padding"),
    )
