"""Null handling and data-quality rules. Every report is one pass over the data."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.functions.conditions import is_missing
from tallgrass.operators.columns import numeric_columns, quoted


@dataclass(frozen=True)
class Rule:
    """``broken`` builds a condition that is true for a violating row."""

    name: str
    column: str
    broken: Callable[[], Column]
    severity: str = "error"


def na_drop(df: DataFrame, *, how: str = "any", subset: list[str] | None = None) -> DataFrame:
    return df.dropna(how=how, subset=subset)


def na_fill(df: DataFrame, value, subset: list[str] | None = None) -> DataFrame:
    """Columns of another type than the value are left as they are."""
    return df.fillna(value, subset=subset)


def na_replace(df: DataFrame, mapping: dict, subset: list[str]) -> DataFrame:
    return df.replace(mapping, subset=subset)


def missing_by_column(df: DataFrame) -> DataFrame:
    """Nulls (and NaN in floating columns) per column, as rows."""
    counts = [F.struct(F.lit(c).alias("column"), F.count_if(is_missing(c, k)).alias("missing")) for c, k in df.dtypes]
    return df.agg(F.array(*counts).alias("r")).select(F.inline("r"))


def check_rules(df: DataFrame, rules: list[Rule], by: list[str] | None = None) -> DataFrame:
    """Violations of all rules from a single aggregation, per value of ``by`` if given, with
    the rows checked."""
    rows = [F.struct(F.lit(r.name).alias("rule"), F.lit(r.column).alias("column"), F.lit(r.severity).alias("severity"),
                     F.count_if(r.broken()).alias("violations")) for r in rules]
    if not by:
        return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))
    return df.groupBy(*by).agg(F.array(*rows).alias("r"), F.count(F.lit(1)).alias("n")).select(*by, "n", F.inline("r"))


def not_missing(df: DataFrame) -> list[Rule]:
    """A warning per column for nulls and NaN."""
    return [Rule("missing", c, lambda c=c, k=k: is_missing(c, k), "warning") for c, k in df.dtypes]


def non_negative(df: DataFrame, columns: list[str]) -> list[Rule]:
    present = [c for c in columns if c in numeric_columns(df)]
    return [Rule("non_negative", c, lambda c=c: quoted(c) < 0) for c in present]


def within(column: str, low, high, name: str) -> Rule:
    return Rule(name, column, lambda: (quoted(column) < low) | (quoted(column) > high))


def in_domain(column: str, values: list, name: str = "domain") -> Rule:
    return Rule(name, column, lambda: ~quoted(column).isin(values))


def close_to(column: str, expected: Callable[[], Column], tolerance: float, name: str) -> Rule:
    return Rule(name, column, lambda: F.abs(quoted(column) - expected()) > tolerance, "warning")


def split_not_null(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Accepted rows and rows rejected for a null key."""
    bad = F.lit(False)
    for k in keys:
        bad = bad | quoted(k).isNull()
    return df.where(~bad), df.where(bad)


def multi_occurrence(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
