"""Joins beyond a single call.

Dimension sides carry no unconditional broadcast hint: Spark broadcasts by its own
size estimate and, with adaptive execution, by the real size, and splits skewed
partitions of the sort-merge join it falls back to.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.session import broadcast_checked


def join_on_key(dfs: list[DataFrame], key: str, *, how: str = "left", suffixes: list[str]) -> DataFrame:
    """Join frames in turn on one key; every other column gets its frame's suffix."""

    def suffixed(df: DataFrame, suffix: str) -> DataFrame:
        return df.select(key, *[F.col(c).alias(c + suffix) for c in df.columns if c != key])

    parts = [suffixed(df, s) for df, s in zip(dfs, suffixes, strict=True)]
    return reduce(lambda a, b: a.join(b, key, how), parts)


def join_star(fact: DataFrame, dims: list[tuple[DataFrame, str, str, str]]) -> DataFrame:
    """Join ``(dim, fact_key, dim_key, how)`` dimensions to a fact table."""
    for dim, fact_key, dim_key, how in dims:
        fact = fact.join(dim, F.col(fact_key) == F.col(dim_key), how)
    return fact


def join_broadcast(df: DataFrame, small: DataFrame, on, how: str = "inner", *, max_bytes: int = 10 << 20) -> DataFrame:
    """Join with a broadcast hint if Spark's estimate of the small side is at most ``max_bytes``."""
    return df.join(broadcast_checked(small, max_bytes), on, how)


def product_with_small(df: DataFrame, small: DataFrame, *, max_bytes: int = 10 << 20) -> DataFrame:
    """Cartesian product; ``small`` is broadcast if its estimate is at most ``max_bytes``, and any
    larger one is multiplied partition by partition."""
    return df.crossJoin(broadcast_checked(small, max_bytes))


def after_scalar(df: DataFrame, col: str, threshold: DataFrame, default: Column) -> DataFrame:
    """Rows with ``col`` above the single value of a one-row frame, or above ``default`` if that value is null.

    The value is a scalar subquery of the same plan: it is worked out once, ahead of the scan.
    """
    return df.where(F.col(col) > F.coalesce(threshold.scalar(), default))
