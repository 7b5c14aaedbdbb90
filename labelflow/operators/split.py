"""Exact, reproducible stratified split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelflow.scale import dimension, materialize, table_and_rows
from labelflow.schema import DEFAULT_SEED, DEFAULT_TEST_SIZE

# Leading hex digits of the order key that are counted before any ranking.
_BUCKET_DIGITS = 4
# Copies written by one task when identical rows straddle the cut.
_COPY_BLOCK = 1_000_000


def order_key(key: str, seed: int = DEFAULT_SEED) -> Column:
    """Pseudo-random but reproducible order of rows: md5 over key and seed, then the key."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.concat(F.md5(F.concat(text, F.lit(f"|{seed}"))), text)


def allocate(counts: DataFrame, label: str, test_size: float = DEFAULT_TEST_SIZE) -> DataFrame:
    """`(label, n, n_train, n_test)` from `(label, n)`.

    `ceil(test_size * rows)` rows go to the test side. Train rows are dealt to the classes by
    largest remainder, ties to the smaller class. The windows run over one row per class.
    """
    whole = W.partitionBy()
    total = F.sum("n").over(whole)
    test_rows = F.ceil(total.cast("double") * F.lit(float(test_size)))
    quotas = (
        counts.select(label, "n", total.alias("total"), test_rows.alias("test"))
        .withColumn("train", F.col("total") - F.col("test"))
        # Two counts multiplied can pass 64 bits.
        .withColumn("product", F.expr("CAST(n AS DECIMAL(19,0)) * CAST(train AS DECIMAL(19,0))"))
        .withColumn("base", F.expr("product div total"))
        .withColumn("rest", F.expr("product % total"))
    )
    place = F.row_number().over(W.orderBy(F.desc("rest"), F.asc(label)))
    return (
        quotas.withColumn("place", place)
        .withColumn("spare", F.col("train") - F.sum("base").over(whole))
        .withColumn("n_train", F.expr("base + CASE WHEN place <= spare THEN 1 ELSE 0 END"))
        .select(label, "n", "n_train", (F.col("n") - F.col("n_train")).alias("n_test"))
    )


def _check_classes(sizes: DataFrame, rows: list[Row] | None, label: str) -> None:
    """Raise when a class of `_checked` sizes is missing or too small for a stratified split."""
    bad = [r for r in rows if r.bad] if rows is not None else sizes.filter("bad").take(20)
    if bad:
        names = ", ".join(f"{r[label]} ({r.n} rows)" for r in bad[:20])
        raise ValueError(
            "a stratified split needs a class on every row, two rows per class, and room for "
            f"every class on both sides; see {names}"
        )


def _checked(sizes: DataFrame, label: str) -> DataFrame:
    """`(label, n, wanted, bad)`: train rows per class, and whether the class forbids a split."""
    whole = W.partitionBy()
    room = F.least(F.sum("n_train").over(whole), F.sum("n_test").over(whole))
    bad = F.col(label).isNull() | (F.col("n") < 2) | (room < F.count("*").over(whole))
    return sizes.select(label, "n", F.col("n_train").alias("wanted"), bad.alias("bad"))


def split_preconditions(
    counts: DataFrame, label: str, test_size: float = DEFAULT_TEST_SIZE
) -> DataFrame:
    """`(rule, class, rows, needed)`: every rule that a stratified split of `(label, n)` would break.

    `class_missing`: rows without a class; `class_too_small`: a class of fewer than two rows;
    `no_room_for_training`, `no_room_for_test`: a side with fewer rows than there are classes
    (`class` is null). No row means that the split is possible. The windows run over a row a class.
    """
    sized = allocate(counts, label, test_size)
    total = sized.agg(
        F.sum("n_train").alias("train"), F.sum("n_test").alias("test"), F.count("*").alias("classes"))

    def rule(name: str, value: Column, rows: Column, needed: Column):
        return F.struct(F.lit(name).alias("rule"), value.cast("string").alias("class"),
                        rows.alias("rows"), needed.cast("long").alias("needed"))

    own = sized.select(F.array(
        F.when(F.col(label).isNull(), rule("class_missing", F.lit(None), F.col("n"), F.lit(0))),
        F.when(F.col(label).isNotNull() & (F.col("n") < 2), rule("class_too_small", F.col(label), F.col("n"), F.lit(2))),
    ).alias("broken"))
    sides = total.select(F.array(*[
        F.when(F.col(side) < F.col("classes"), rule(f"no_room_for_{name}", F.lit(None), F.col(side), F.col("classes")))
        for side, name in (("train", "training"), ("test", "test"))
    ]).alias("broken"))
    return own.unionAll(sides).select(F.explode("broken").alias("b")).filter("b IS NOT NULL").select("b.*")


def _buckets(rows: DataFrame, label: str) -> DataFrame:
    """Rows per class and leading hex digits of `h`; at most 16^4 per class at any row count."""
    counts = rows.groupBy(label, F.substring("h", 1, _BUCKET_DIGITS).alias("bucket")).agg(
        F.count("*").alias("n")
    )
    return materialize(counts, "split-buckets")


def _cuts(rows: DataFrame, buckets: DataFrame, wanted: DataFrame, label: str, small: bool) -> DataFrame:
    """`(label, cut, copies, take)`: the value of `h` at which each class has its `wanted` rows.

    `copies` rows carry that value and `take` of them are still wanted. Only the bucket that
    holds the cut is looked at row by row. `small` says that the number of classes was checked:
    there is one crossing bucket per class, so that table may be broadcast too.
    """
    upto = F.sum("n").over(W.partitionBy(label).orderBy("bucket"))
    crossing = (
        buckets.withColumn("upto", upto)
        .join(wanted, label)
        .filter((F.col("upto") >= F.col("wanted")) & (F.col("upto") - F.col("n") < F.col("wanted")))
        .select(label, "bucket", (F.col("wanted") - F.col("upto") + F.col("n")).alias("inside"))
    )
    values = (
        rows.withColumn("bucket", F.substring("h", 1, _BUCKET_DIGITS))
        .join(F.broadcast(crossing) if small else crossing, [label, "bucket"])
        .groupBy(label, "h", "inside")
        .agg(F.count("*").alias("copies"))
    )
    reach = F.sum("copies").over(W.partitionBy(label).orderBy("h"))
    return (
        values.withColumn("reach", reach)
        .filter((F.col("reach") >= F.col("inside")) & (F.col("reach") - F.col("copies") < F.col("inside")))
        .select(
            label, F.col("h").alias("cut"), "copies",
            (F.col("inside") - F.col("reach") + F.col("copies")).alias("take"),
        )
    )


def stratified_split(
    df: DataFrame,
    key: str,
    label: str,
    test_size: float = DEFAULT_TEST_SIZE,
    seed: int = DEFAULT_SEED,
    side: DataFrame | None = None,
) -> DataFrame:
    """Add the boolean `is_train`; class sizes are exact and the same rows are picked every time.

    `side` is a narrow table with the key and label of all rows; with it, `df` is read once only.

    Rows of a class are taken in `order_key` order until its train rows are complete. No class is
    ranked as a whole: one pass over two columns counts buckets, a second one looks at the bucket
    where each class is cut, and the last one compares every row with the cut of its class. Where
    rows share the key at the cut, their content decides (`_split_shared`).
    """
    rows = (df if side is None else side).select(label, order_key(key, seed).alias("h"))
    buckets = _buckets(rows, label)
    counts = buckets.groupBy(label).agg(F.sum("n").alias("n"))
    checked = _checked(allocate(counts, label, test_size), label)
    sizes, few_sizes = table_and_rows(checked)
    _check_classes(sizes, few_sizes, label)
    found = _cuts(rows, buckets, sizes.select(label, "wanted"), label, few_sizes is not None)
    cuts, few_cuts = table_and_rows(found)

    placed = df.withColumn("h", order_key(key, seed)).join(cuts, label, "left")
    # A class without train rows has no cut and is all test.
    before = F.coalesce(F.col("h") <= F.col("cut"), F.lit(False))
    columns = [*df.columns, "is_train"]
    inside_copies = cuts.filter("take < copies")
    divided = (
        any(r.take < r.copies for r in few_cuts) if few_cuts is not None else inside_copies.take(1)
    )
    if not divided:
        return placed.withColumn("is_train", before).select(*columns)

    at_cut = F.coalesce((F.col("h") == F.col("cut")) & (F.col("take") < F.col("copies")), F.lit(False))
    clear = placed.filter(~at_cut).withColumn("is_train", before).select(*columns)
    shared = placed.filter(at_cut).select(*df.columns)
    return clear.unionByName(_split_shared(shared, inside_copies, label, few_cuts is not None))


def split_hash(rows: DataFrame, key: str, label: str) -> str:
    """A number that depends on which rows, by key and class, are on which side, but not on their order.

    The sum of 52 bits of md5 over key, class and side, so repeated rows count too.
    """
    text = F.concat_ws("|", F.col(key).cast("string"), F.col(label).cast("string"), F.col("is_train").cast("string"))
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("decimal(20,0)")
    return str(rows.agg(F.coalesce(F.sum(bits), F.lit(0))).first()[0])


def _split_shared(shared: DataFrame, cuts: DataFrame, label: str, small: bool) -> DataFrame:
    """Divide rows of one key per class: the first `take` in content order go to the train side.

    Identical rows are interchangeable: where they straddle the cut they are written again from
    their count, block by block.
    """
    content = F.md5(F.to_json(F.struct(*shared.columns), {"ignoreNullFields": "false"}))
    hashed = shared.withColumn("h", content)
    rows = hashed.select(label, "h")
    wanted = cuts.select(label, F.col("take").alias("wanted"))
    inner = dimension(_cuts(rows, _buckets(rows, label), wanted, label, small), name="split-cuts")

    placed = hashed.join(inner, label)
    columns = [*shared.columns, "is_train"]
    at_cut = (F.col("h") == F.col("cut")) & (F.col("take") < F.col("copies"))
    clear = placed.filter(~at_cut).withColumn("is_train", F.col("h") <= F.col("cut"))
    same = (
        placed.filter(at_cut)
        .groupBy("h", "take", "copies")
        .agg(F.any_value(F.struct(*shared.columns)).alias("row"))
        .withColumn("block", F.explode(F.expr(f"sequence(0, (copies - 1) div {_COPY_BLOCK})")))
        .repartition("h", "block")
    )
    copy = F.expr(
        f"sequence(block * {_COPY_BLOCK} + 1, least(copies, (block + 1) * {_COPY_BLOCK}))"
    )
    written = same.withColumn("copy", F.explode(copy)).select(
        "row.*", (F.col("copy") <= F.col("take")).alias("is_train")
    )
    return clear.select(*columns).unionByName(written)
