"""Conversion funnels over a user table and an event log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def funnel_reach(users: DataFrame, events: DataFrame, key: str, stages: dict[str, Column]) -> DataFrame:
    """One 0/1 column per stage and user.

    All stages come from one pass over the log, combined before the shuffle, rather
    than from one join per stage.
    """
    reached = events.groupBy(key).agg(*[F.max(F.when(c, 1).otherwise(0)).alias(n) for n, c in stages.items()])
    joined = users.join(reached, key, "left")
    return joined.select(*users.columns, *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in stages])


def stage_totals(reach: DataFrame, stages: list[str]) -> DataFrame:
    rows = [F.struct(F.lit(s).alias("stage"), F.sum(s).alias("reached")) for s in stages]
    return reach.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def funnel_conversion(reach: DataFrame, stages: list[str], segments: list[str]) -> DataFrame:
    """Share of users reaching each stage, over all users and per value of each segment.

    One grouping-sets aggregation; users are first folded per segment combination.
    """
    folded = reach.groupBy(*segments).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(s).alias(s) for s in stages])
    sets = [[], *[[s] for s in segments]]
    grouped = folded.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(s) for s in segments])
    out = grouped.agg(F.sum("_n").alias("users"), *[(F.sum(s) / F.sum("_n")).alias(s) for s in stages],
                      F.grouping_id().alias("_g"))
    label, value = F.lit("all"), F.lit("all")
    for i, segment in enumerate(segments):
        only = (2 ** len(segments) - 1) - 2 ** (len(segments) - 1 - i)
        label = F.when(F.col("_g") == only, segment).otherwise(label)
        value = F.when(F.col("_g") == only, F.col(segment)).otherwise(value)
    return out.select(label.alias("segment"), value.alias("value"), "users", *stages)
