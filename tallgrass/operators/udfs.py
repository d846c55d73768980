"""Python functions over columns, rows and groups; Arrow batches, never row pickling."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_udf(fn: Callable[[str], str]) -> Callable[[Column], Column]:
    """Vectorised form of a Python function from text to text."""

    @F.pandas_udf("string")
    def apply(texts: pd.Series) -> pd.Series:
        return texts.map(fn, na_action="ignore")

    return apply


def capitalize_each_word(text: str) -> str:
    return " ".join(w[:1].upper() + w[1:] for w in text.split(" "))


def foreach_batch_of_rows(df: DataFrame, action: Callable[[pd.DataFrame], None]) -> DataFrame:
    """Run an action on every batch on the executors; returns rows handled per batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            action(batch)
            yield pd.DataFrame({"handled": [len(batch)]})

    return df.mapInPandas(run, "handled bigint")


def group_map(df: DataFrame, keys: list[str], fn, schema: str) -> DataFrame:
    """Any frame per group. For groups of bounded size, such as one calendar series."""
    return df.groupBy(*keys).applyInPandas(fn, schema)
