"""What several operators of this package share."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word is a run of anything but the six ASCII white-space characters.
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
# Digits, ASCII letters and all characters beyond ASCII.
WORDS_OF_LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# At most about this many characters are worked on as numpy arrays at once.
CHUNK_CHARS = 1 << 20


def texts_of(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`(doc_id, text)` of a table with any other columns; a null text counts as an empty one."""
    return docs.select(
        F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )


def fold(key: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of the key as text, modulo `folds`; a null key counts as an empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % folds


def arrow_type(schema: str):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def sliced(batches: Iterator[pa.RecordBatch], most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Batches in slices of about `most_bytes`, of one row at least."""
    for b in batches:
        rows = max(1, b.num_rows * most_bytes // max(1, b.nbytes))
        yield from (b.slice(at, rows) for at in range(0, b.num_rows, rows))


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int] | None:
    """The C library's `malloc_trim`, where it has one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):
        return None


def release() -> None:
    """Give unused memory back to the system, Arrow's and that of freed arrays and texts: a worker outlives
    its task and stands beside the next stage's."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def map_batches(
    df: DataFrame, fn: Callable[[Iterator[dict[str, list]]], Iterator[dict[str, object]]], schema: str,
    most_bytes: int | None = None,
) -> DataFrame:
    """`mapInArrow` over dictionaries of columns: lists go in, lists or numpy arrays come out.

    With `most_bytes`, larger batches come in slices of about so many bytes.
    """
    wanted = arrow_type(schema)  # parsed by the driver's session

    def run(batches):
        parts = sliced(batches, most_bytes) if most_bytes else (b for b in batches if b.num_rows)
        dicts = (dict(zip(b.schema.names, (c.to_pylist() for c in b.columns))) for b in parts)
        try:
            for out in fn(dicts):
                arrays = [pa.array(out[f.name], type=f.type) for f in wanted]
                yield pa.RecordBatch.from_arrays(arrays, schema=wanted)
        finally:
            arrays = out = None
            release()

    return df.mapInArrow(run, schema)
