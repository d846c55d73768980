"""Projection, column naming and metadata operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters a managed table does not accept in column names.
FORBIDDEN = " ,;{}()\n\t="

NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def quoted(name: str) -> Column:
    """Column by literal name, whatever dots or blanks it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def project(df: DataFrame, *columns) -> DataFrame:
    return df.select(*columns)


def add_constant(df: DataFrame, name: str, value, *, position: int | None = None) -> DataFrame:
    """Constant column, at the end or at a given position."""
    names = [quoted(c) for c in df.columns]
    names.insert(len(names) if position is None else position, F.lit(value).alias(name))
    return df.select(*names)


def sanitize_columns(df: DataFrame, *, forbidden: str = FORBIDDEN, replacement: str = "_") -> DataFrame:
    """Replace forbidden characters; names that collide get ``_1``, ``_2``, …"""
    taken: set[str] = set()
    names = []
    for name in df.columns:
        clean = "".join(replacement if ch in forbidden else ch for ch in name.strip())
        unique, n = clean, 0
        while unique.lower() in taken:
            n += 1
            unique = f"{clean}{replacement}{n}"
        taken.add(unique.lower())
        names.append(unique)
    return df.toDF(*names)


def rename_symbols(df: DataFrame, symbols: dict[str, str]) -> DataFrame:
    """Replace each symbol of the mapping in every column name."""

    def clean(name: str) -> str:
        name = name.strip()
        for symbol, text in symbols.items():
            name = name.replace(symbol, text)
        return name

    return df.toDF(*[clean(c) for c in df.columns])


def numeric_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind.split("(")[0] in NUMERIC_TYPES]


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per column: count, mean, stddev, min, max; a single pass over the data."""
    stats = []
    for c in cols:
        x = quoted(c).cast("double")
        stats.append(F.struct(F.lit(c).alias("column"), F.count(x).alias("count"), F.avg(x).alias("mean"),
                              F.stddev(x).alias("stddev"), F.min(x).alias("min"), F.max(x).alias("max")))
    return df.agg(F.array(*stats).alias("s")).select(F.inline("s"))


def summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """:func:`describe` with exact quartiles, ranked for all columns together."""
    from tallgrass.operators.ordered import exact_quantiles

    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), quoted(c).cast("double").alias("value")) for c in cols])).alias("r")).select("r.*")
    quartiles = exact_quantiles(long, ["column"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return describe(df, cols).join(quartiles, "column", "left")


def schema_rows(df: DataFrame) -> DataFrame:
    """Column names and types as a frame."""
    rows = [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "ordinal int, column string, type string")


def to_json_rows(df: DataFrame, name: str = "json") -> DataFrame:
    """Each row as a JSON document, built on the executors."""
    return df.select(F.to_json(F.struct(*[quoted(c) for c in df.columns])).alias(name))


def take_checked(df: DataFrame, limit: int = 10_000) -> list:
    """Rows on the driver; raises rather than pulling more than ``limit``."""
    rows = df.take(limit + 1)
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows; aggregate or write them instead")
    return rows


def top_rows(df: DataFrame, order: list, n: int) -> DataFrame:
    """First ``n`` rows in a stated order (``TakeOrderedAndProject``, no full sort)."""
    return df.orderBy(*order).limit(n)
