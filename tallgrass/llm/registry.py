"""Registered queries of this package; ``load_all`` imports the modules that hold them."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_MODULES = ("minhash", "mixing", "bpe", "urls", "rules", "warc", "lines", "fingerprints", "tokens", "suffixes", "phrases", "spelling", "crf")


def query(name: str, oracle: str | None = None):
    """Register a ``(spark, sf_dir) -> DataFrame`` callable, with its SQL if it has one."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle.strip()
        return fn

    return register


def load_all() -> None:
    for module in _MODULES:
        import_module(f"tallgrass.llm.{module}")
