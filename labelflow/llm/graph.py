"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelflow.scale import materialize

MAX_ROUNDS = 60  # rounds are logarithmic in the number of nodes


def components(edges: DataFrame) -> DataFrame:
    """`(node, root)` of every node in `edges (a, b)`; the root is the smallest node reachable.

    Alternates two steps: each node ties its larger neighbours to its smallest one, then ties its
    smaller neighbours and itself to the smallest. Both are a partial minimum per node and a join;
    every round is a written table, so lineage stays short and lost executors cost one round.
    """
    current = materialize(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    for _ in range(MAX_ROUNDS):
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        larger = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(larger.filter("u <> v").distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
        current = materialize(small.filter("u <> v").distinct(), "small-star")
        found = current.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(found) == state:
            break
        state = tuple(found)
    else:
        raise RuntimeError("components did not settle")
    roots = current.select("v").distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("v", "v"))
