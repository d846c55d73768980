"""Array, map and JSON expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def element(items: Column, index: int) -> Column:
    """0-based element; null past the end."""
    return F.get(items, F.lit(index))


def without_empty(items: Column) -> Column:
    return F.array_remove(items, "")


def sorted_unique(items: Column) -> Column:
    return F.array_sort(F.array_distinct(items))


def symmetric_difference(a: Column, b: Column) -> Column:
    return F.array_union(F.array_except(a, b), F.array_except(b, a))


def map_value(pairs: Column, key: str, default=None) -> Column:
    """Value of a key, or the default when the key is absent."""
    value = F.try_element_at(pairs, F.lit(key))
    return value if default is None else F.coalesce(value, F.lit(default))
