"""Size checks for small tables, and written tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

# A dimension above this many rows is joined by shuffle instead of broadcast.
BROADCAST_ROWS = 10_000

_local_dir: str | None = None
_written: list[str] = []  # scratch tables of this process


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for written tables: `spark.checkpoint.dir`, as the cluster names it.

    Only a local session may fall back to a folder of this machine.
    """
    global _local_dir
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.sparkContext.getCheckpointDir()
    if shared:
        return f"{shared.rstrip('/')}/labelflow/{spark.sparkContext.applicationId}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="labelflow-")
    return _local_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write `df` once and read it back, so that later stages do not recompute it.

    Unlike cached blocks, the files survive the loss of executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def cleaned_scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that `materialize` writes inside the block; nothing may read them afterwards."""
    before = len(_written)
    try:
        yield
    finally:
        for path in _written[before:]:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        del _written[before:]


def few_rows(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> list[Row] | None:
    """All rows of `df` when there are at most `max_rows`, else None; no more ever reach the driver."""
    rows = df.take(max_rows + 1)
    return rows if len(rows) <= max_rows else None


def table_and_rows(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, name: str = "dimension"
) -> tuple[DataFrame, list[Row] | None]:
    """`dimension` together with its rows when they are few."""
    rows = few_rows(df, max_rows)
    if rows is None:
        return materialize(df, name), None
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)), rows


def dimension(df: DataFrame, max_rows: int = BROADCAST_ROWS, name: str = "dimension") -> DataFrame:
    """Small table for lookups: a broadcast local table when its size is proven, else a written one.

    A larger table keeps its rows, gets no broadcast hint and is left to shuffled joins, which
    AQE splits where keys are skewed.
    """
    return table_and_rows(df, max_rows, name)[0]
