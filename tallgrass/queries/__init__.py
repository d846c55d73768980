"""Registered queries: each Spark callable next to its equivalent SQL text."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_MODULES = (
    "sources", "columns", "filters", "joins", "aggregates", "windows", "ordering", "setops",
    "scalars", "datetimes", "nested", "quality", "udfs", "retail", "rentals", "experiments",
    "customers", "outliers", "models", "series", "measures", "streams",
)


def query(oracle: str | None = None, name: str | None = None):
    """Register a ``(spark, sf_dir) -> DataFrame`` callable, with its SQL if it has one."""

    def register(fn):
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")
        QUERIES[key] = fn
        if oracle:
            ORACLES[key] = oracle.strip()
        return fn

    return register


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Given table, with the columns that its files have now."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def load_all() -> None:
    for module in _MODULES:
        import_module(f"tallgrass.queries.{module}")
