"""Incremental loads on plain files: upsert, high-water append, versioned publish."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert_type1(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target after a merge that updates every matched key and inserts the others.

    ``source`` must hold one row per key (see ``windows.latest_per_key``).
    """
    return target.join(source.select(*keys), keys, "left_anti").unionByName(source)


def high_water(target: DataFrame, date_col: str, *, default: str = "1900-01-01") -> Column:
    """Newest date stored in ``target`` as a literal, or ``default`` if there is none.

    The value is read once, here. A literal reaches the scan of what is compared with it: it
    prunes folders partitioned by date and is pushed to the files, as a subquery isn't.
    """
    kind = dict(target.dtypes)[date_col]
    if kind == "timestamp":
        newest = target.agg(F.unix_micros(F.max(date_col))).first()[0]
        return F.lit(default).cast(kind) if newest is None else F.timestamp_micros(F.lit(newest))
    newest = target.agg(F.max(date_col).cast("string")).first()[0]
    return F.lit(default if newest is None else newest).cast(kind)


def new_rows(target: DataFrame, source: DataFrame, date_col: str, *, default: str = "1900-01-01") -> DataFrame:
    """Source rows dated after the newest target row.

    The comparison is strict: a late row on the newest date already stored is not
    taken, nor is any row for an earlier date.
    """
    return source.where(F.col(date_col) > high_water(target, date_col, default=default))


def append_after_high_water(target: DataFrame, source: DataFrame, date_col: str, *, default: str = "1900-01-01") -> DataFrame:
    return target.unionByName(new_rows(target, source, date_col, default=default))


def publish(df: DataFrame, root: str, view: str, *, partition_by: list[str] | None = None) -> str:
    """Write a new version below ``root`` and point the view at it.

    A version is never overwritten, so a frame still reading the previous one stays
    valid and a write that breaks off leaves the view as it was.
    """
    path = f"{root}/version={uuid.uuid4().hex}"
    writer = df.write.mode("error")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    df.sparkSession.read.parquet(path).createOrReplaceTempView(view)
    return path
