"""Label encoding and class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelflow.functions.codes import lookup
from labelflow.functions.text import is_sentinel
from labelflow.scale import dimension
from labelflow.schema import FUNCTION_INDEX


def category_dictionary(df: DataFrame) -> DataFrame:
    """`(category, category_label)`: ids in numeric order get labels 0, 1, ...; no sentinel.

    An id that is not an integer is an error. The window runs over distinct ids only.
    """
    ids = (
        df.filter(F.col("category_id").isNotNull() & ~is_sentinel(F.col("category_id")))
        .select(F.col("category_id").cast("int").alias("category"))
        .distinct()
    )
    label = F.row_number().over(W.orderBy("category")) - 1
    return ids.select("category", label.alias("category_label"))


def encode_labels(df: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """Add `category_label` (null for the sentinel: ignored on axis 1) and `function_label`."""
    table = dimension(category_dictionary(df) if dictionary is None else dictionary)
    number = F.when(~is_sentinel(F.col("category_id")), F.col("category_id")).cast("int")
    return (
        df.withColumn("category", number)
        .join(table, "category", "left")
        .drop("category")
        .withColumn("function_label", lookup(F.col("function_type"), FUNCTION_INDEX))
    )


def encode_single_axis(df: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """Axis 1 alone: sentinel rows leave, `category_id` becomes an integer with a dense label."""
    real = df.filter(~is_sentinel(F.col("category_id")))
    known = dimension(category_dictionary(real)) if dictionary is None else dictionary
    table = known.withColumnRenamed("category", "category_id")
    return real.withColumn("category_id", F.col("category_id").cast("int")).join(
        table, "category_id", "left"
    )


def class_weights(train: DataFrame, label: str) -> DataFrame:
    """`(label, n, weight)` with balanced weights `rows / (classes * rows of the class)`."""
    counts = train.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    whole = W.partitionBy()  # over one row per class
    weight = F.sum("n").over(whole) / (F.count("*").over(whole) * F.col("n")).cast("double")
    return counts.select(label, "n", weight.alias("weight"))


def with_class_weight(df: DataFrame, weights: DataFrame, label: str) -> DataFrame:
    """Attach the weight of each row's class as `weight`."""
    return df.join(dimension(weights.select(label, "weight")), label, "left")
