"""Catalog tables and views."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def write_table(df: DataFrame, name: str, *, mode: str = "error", fmt: str = "parquet",
                partition_by: Iterable[str] = (), bucket_by: tuple[int, list[str]] | None = None,
                path: str | None = None) -> None:
    """Save as a catalog table; with ``path`` the table is external, else managed.

    ``bucket_by=(n, columns)`` buckets and sorts the files, so later joins and
    aggregations on those columns need no shuffle.
    """
    writer = df.write.format(fmt).mode(mode)
    partition_by = list(partition_by)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        buckets, columns = bucket_by
        writer = writer.bucketBy(buckets, *columns).sortBy(*columns)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def append_by_name(df: DataFrame, name: str) -> None:
    """``insertInto`` matches by position, so put the columns in table order first."""
    spark = df.sparkSession
    df.select(*spark.table(name).columns).write.insertInto(name)


def register_view(df: DataFrame, name: str, *, replace: bool = True, everywhere: bool = False) -> None:
    """Temporary view; ``everywhere`` makes it global (``global_temp.<name>``)."""
    if everywhere:
        (df.createOrReplaceGlobalTempView if replace else df.createGlobalTempView)(name)
    else:
        (df.createOrReplaceTempView if replace else df.createTempView)(name)


def drop_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.dropTempView(name)


def create_schema(spark: SparkSession, name: str, *, location: str | None = None, use: bool = False) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`{where}")
    if use:
        spark.catalog.setCurrentDatabase(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def table_names(spark: SparkSession, schema: str | None = None) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(schema))
