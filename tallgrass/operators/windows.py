"""Window operators over frames already aggregated to a calendar grain.

A group here has at most one row per day or month, so its size is bounded by the
calendar and an ordinary window is safe. Row-grained windows are in ``ordered``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rolling(df: DataFrame, keys: list[str], order: str, col: str, *, periods: int, fns: dict[str, Column],
            full_only: bool = True) -> DataFrame:
    """Aggregates over the last ``periods`` rows of each series; null until the frame is full."""
    frame = Window.partitionBy(*keys).orderBy(order).rowsBetween(1 - periods, 0)
    full = F.count(col).over(frame) == periods
    cols = [F.when(full, c.over(frame)) if full_only else c.over(frame) for c in fns.values()]
    return df.select("*", *[c.alias(n) for n, c in zip(fns, cols, strict=True)])


def change(df: DataFrame, keys: list[str], order: str, col: str, *, name: str = "change") -> DataFrame:
    """Value less the value one row before."""
    series = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn(name, F.col(col) - F.lag(col).over(series))


def growth(df: DataFrame, keys: list[str], order: str, col: str, *, name: str = "growth") -> DataFrame:
    """Relative change against one row before; null where there is none or it is zero."""
    series = Window.partitionBy(*keys).orderBy(order)
    before = F.lag(col).over(series)
    return df.withColumn(name, F.try_divide(F.col(col) - before, before))


def time_window_agg(df: DataFrame, keys: list[str], ts: str, width: str, slide: str | None, aggs: list[Column]) -> DataFrame:
    """Tumbling or sliding event-time windows; the same call serves batch and stream."""
    window = F.window(ts, width, slide) if slide else F.window(ts, width)
    grouped = df.groupBy(*keys, window.alias("w")).agg(*aggs)
    rest = [c for c in grouped.columns if c not in (*keys, "w")]
    return grouped.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *rest)


def group_value(df: DataFrame, keys: list[str], agg: Column, name: str) -> DataFrame:
    """Group aggregate copied to every row, by aggregation and join.

    Unlike a window this combines before the shuffle and lets adaptive execution
    split a hot key on the join.
    """
    per_key = df.groupBy(*keys).agg(agg.alias(name))
    return df.join(per_key, keys, "left")


def first_rows(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """First row per key; Spark limits each task to one row per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, keys: list[str], order: str, tie_break: list) -> DataFrame:
    """Row with the largest ``order`` per key; ``tie_break`` makes the choice total."""
    return first_rows(df, keys, [F.col(order).desc(), *tie_break])
