"""Lookups in fixed code tables."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def lookup(key: Column, table: dict) -> Column:
    """Value of `key` in a small constant table, null when absent."""
    entries = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    return F.try_element_at(entries, key)


def lookup_or_blank(key: Column, table: dict) -> Column:
    return F.coalesce(lookup(key, table), F.lit(""))


def at_index(values: list, index: Column) -> Column:
    """Element of a constant list at a zero-based position, null when out of range."""
    return F.get(F.array(*[F.lit(v) for v in values]), index)
