"""Array columns as logit and probability vectors."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and use it inside `body`."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def softmax(logits: Column) -> Column:
    return _let(F.array_max(logits), lambda peak: _let(
        F.transform(logits, lambda v: F.exp(v - peak)), lambda powers: _let(
            _total(powers), lambda total: F.transform(powers, lambda v: v / total))))


def argmax(values: Column) -> Column:
    """Zero-based position of the largest value, the first one on ties; null for a null array."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def log_softmax_at(logits: Column, index: Column) -> Column:
    """Log probability of one class, stable for large logits."""
    return _let(F.array_max(logits), lambda peak: (
        F.element_at(logits, (index + 1).cast("int"))
        - peak
        - F.log(_total(F.transform(logits, lambda v: F.exp(v - peak))))))


def linear_logits(
    vector: Column, weights: Sequence[Sequence[float]], bias: Sequence[float]
) -> Column:
    """`W x + b` as an array expression.

    Needs no Python worker; for wide vectors the batch scorer is several times faster.
    """
    def one(row: Sequence[float], offset: float) -> Column:
        coefficients = F.array(*[F.lit(float(w)) for w in row])
        products = F.zip_with(vector, coefficients, lambda x, w: x.cast("double") * w)
        return F.aggregate(products, F.lit(float(offset)), lambda acc, v: acc + v)

    return F.array(*[one(row, offset) for row, offset in zip(weights, bias)])
