"""Guards, flags, recodes and links as column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def n_rows() -> Column:
    return F.count(F.lit(1))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is null."""
    return F.when(condition, 1).otherwise(0)


def safe_divide(a: Column, b: Column) -> Column:
    """Null instead of an error for a zero divisor."""
    return F.try_divide(a, b)


def recode(col: Column, mapping: dict) -> Column:
    """Value by mapping; null for values the mapping does not hold."""
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(pairs, col)


def lookup_link(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), F.url_encode(value))


def is_missing(name: str, kind: str) -> Column:
    """Null or, for floating types only, NaN."""
    col = F.col("`" + name.replace("`", "``") + "`")
    return col.isNull() | F.isnan(col) if kind in ("float", "double") else col.isNull()
