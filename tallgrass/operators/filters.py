"""Filters with optional parts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The password rule set; every pattern must match.
PASSWORD_RULES = ("^.{6,12}$", "[a-z]", "[0-9]", "[A-Z]", "[$#@]", r"^\S+$")


def apply_param_filters(df: DataFrame, selected: dict[str, list]) -> DataFrame:
    """Membership filter per column; an empty list leaves that column open."""
    for column, values in selected.items():
        if values:
            df = df.where(F.col(column).isin(list(values)))
    return df


def matches_all(text: Column, patterns) -> Column:
    """True where the text matches every pattern."""
    return reduce(lambda a, b: a & b, [text.rlike(p) for p in patterns])
