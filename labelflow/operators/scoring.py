"""Two-axis scoring: model logits per row, then predictions, confidences and keyword flags."""

from collections.abc import Callable, Sequence
from typing import Iterator

import pyarrow as pa
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelflow.functions.codes import at_index, lookup_or_blank
from labelflow.functions.text import blank_if_null, keyword_groups
from labelflow.functions.vectors import argmax, softmax
from labelflow.schema import (
    CATEGORY_NAMES,
    FUNCTION_INDEX,
    FUNCTION_NAMES,
    MINORITY_KEYWORDS,
)

# Bytes of text that a text model gets at once.
TEXT_BATCH_BYTES = 4 << 20

_LOGITS = T.StructType([
    T.StructField("category", T.ArrayType(T.DoubleType())),
    T.StructField("function", T.ArrayType(T.DoubleType())),
])


def linear_heads(
    category_weights: Sequence[Sequence[float]], category_bias: Sequence[float],
    function_weights: Sequence[Sequence[float]], function_bias: Sequence[float],
) -> Callable:
    """Model factory for two linear heads on one shared vector, as `batch_logits` expects it."""
    def load():
        import numpy as np

        wc, bc = np.asarray(category_weights, dtype="float64"), np.asarray(category_bias)
        wf, bf = np.asarray(function_weights, dtype="float64"), np.asarray(function_bias)

        def predict(vectors):
            x = vectors.astype("float64")
            return {"category": x @ wc.T + bc, "function": x @ wf.T + bf}

        return predict

    return load


def batch_logits(
    load_model: Callable, *inputs: Column, widths: Sequence[int | None] = (None,),
    batch_size: int = 1024,
) -> Column:
    """Logits struct `(category, function)` of any user model, in Arrow batches.

    `load_model()` runs once per Python worker and returns a function from numpy batches, one per
    input (strings, or rows of `width` numbers), to a dict of two arrays. A null input gives a
    null struct. The column is marked nondeterministic so that a later filter cannot make the
    model run twice.
    """
    udf = predict_batch_udf(
        load_model, return_type=_LOGITS, batch_size=batch_size,
        input_tensor_shapes=[[w] if w else None for w in widths] if any(widths) else None,
    ).asNondeterministic()
    present = F.lit(True)
    filled = []
    for col, width in zip(inputs, widths, strict=True):
        present = present & col.isNotNull()
        filler = F.array_repeat(F.lit(0).cast("float"), width) if width else F.lit("")
        filled.append(F.coalesce(col, filler))
    return F.when(present, udf(*filled))


def with_logits(
    df: DataFrame, load_model: Callable, *inputs: str,
    widths: Sequence[int | None] = (None,), batch_size: int = 1024,
) -> DataFrame:
    """Add `category_logits` and `function_logits`; both heads come from one model call."""
    scores = batch_logits(
        load_model, *map(F.col, inputs), widths=widths, batch_size=batch_size
    )
    return df.withColumn("_scores", scores).withColumns({
        "category_logits": F.col("_scores.category"),
        "function_logits": F.col("_scores.function"),
    }).drop("_scores")


def _by_bytes(texts, most: int):
    """Slices of an Arrow array of strings, of at most so many bytes or of a single text."""
    import numpy as np
    import pyarrow.compute as pc

    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield texts.slice(start, end - start)
        start = end


def text_logits(load_model: Callable, text: Column, batch_bytes: int = TEXT_BATCH_BYTES) -> Column:
    """Logits struct `(category, function)` of a model that reads whole texts.

    `load_model()` runs once per task and returns a function from a list of strings to a dict of two
    arrays with a row per string. Only the text column goes to Python, in Arrow batches; the model
    gets them in lists of at most `batch_bytes` of UTF-8, or a single longer text. A null text gives
    a null struct. The column is marked nondeterministic, so the model runs once per row.
    """
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        predict = load_model()
        kind = pa.list_(pa.float64())
        for texts in batches:
            columns = {"category": [], "function": []}
            for part in _by_bytes(texts, batch_bytes):
                found = predict(part.to_pylist())
                for name, lists in columns.items():
                    lists.extend([float(x) for x in row] for row in found[name])
            yield pa.StructArray.from_arrays([pa.array(c, kind) for c in columns.values()], names=list(columns))

    udf = F.arrow_udf(run, _LOGITS).asNondeterministic()
    return F.when(text.isNotNull(), udf(F.coalesce(text, F.lit(""))))


def with_text_logits(
    df: DataFrame, load_model: Callable, text: str = "combined_text", batch_bytes: int = TEXT_BATCH_BYTES
) -> DataFrame:
    """Add `category_logits` and `function_logits` of a model that reads texts."""
    scores = text_logits(load_model, F.col(text), batch_bytes)
    return df.withColumn("_scores", scores).withColumns({
        "category_logits": F.col("_scores.category"),
        "function_logits": F.col("_scores.function"),
    }).drop("_scores")


def with_predictions(
    df: DataFrame,
    categories: Sequence[int] = tuple(CATEGORY_NAMES),
    functions: Sequence[str] = tuple(FUNCTION_INDEX),
    category_names: dict[int, str] = CATEGORY_NAMES,
    function_names: dict[str, str] = FUNCTION_NAMES,
) -> DataFrame:
    """Add the predicted label and confidence of each axis; the two logits columns leave.

    `categories` and `functions` are the codes behind the label indexes. Everything is computed
    inside the row. Also added: the label indexes `category_pred` and `function_pred`.
    """
    probabilities = df.withColumns({
        "_pc": softmax(F.col("category_logits")),
        "_pf": softmax(F.col("function_logits")),
    }).drop("category_logits", "function_logits")
    indexed = probabilities.withColumns({
        "category_pred": argmax(F.col("_pc")),
        "function_pred": argmax(F.col("_pf")),
        "category_confidence": F.array_max("_pc"),
        "function_confidence": F.array_max("_pf"),
    }).drop("_pc", "_pf")
    category = at_index(list(categories), F.col("category_pred"))
    function = at_index(list(functions), F.col("function_pred"))
    return indexed.withColumns({
        "predicted_category_id": category,
        "predicted_category_name": lookup_or_blank(category, category_names),
        "predicted_function_type": function,
        "predicted_function_name": lookup_or_blank(function, function_names),
        "min_confidence": F.least("category_confidence", "function_confidence"),
    })


def with_keyword_flags(
    df: DataFrame,
    description: str = "description",
    name: str = "app_name",
    groups: dict[str, list[str]] = MINORITY_KEYWORDS,
) -> DataFrame:
    """Add `minority_candidate`: keyword groups found in description and name."""
    text = F.concat(blank_if_null(F.col(description)), F.lit(" "), blank_if_null(F.col(name)))
    return df.withColumn("minority_candidate", keyword_groups(text, groups))
