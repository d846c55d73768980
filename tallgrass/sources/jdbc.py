"""JDBC reads and writes. Credentials are parameters and are never stored here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_options(url: str, table: str | None = None, *, query: str | None = None,
                 driver: str | None = None, partition_column: str | None = None,
                 lower=None, upper=None, num_partitions: int | None = None,
                 fetch_size: int = 10_000) -> dict[str, str]:
    """Reader options; a partitioned read needs column, bounds and count together."""
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table and query")
    options = {"url": url, "fetchsize": str(fetch_size)}
    options["dbtable" if table else "query"] = table or query
    if driver:
        options["driver"] = driver
    split = (partition_column, lower, upper, num_partitions)
    if any(v is not None for v in split):
        if any(v is None for v in split):
            raise ValueError("partition_column, lower, upper and num_partitions go together")
        if query:
            raise ValueError("a partitioned read needs a table; pass the query as a subselect")
        options |= {"partitionColumn": partition_column, "lowerBound": str(lower),
                    "upperBound": str(upper), "numPartitions": str(num_partitions)}
    return options


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, *,
              properties: dict[str, str] | None = None, **options) -> DataFrame:
    return (spark.read.format("jdbc").options(**read_options(url, table, **options))
            .options(**(properties or {})).load())


def write_jdbc(df: DataFrame, url: str, table: str, *, mode: str = "overwrite",
               properties: dict[str, str] | None = None, num_partitions: int | None = None,
               batch_size: int = 10_000) -> None:
    """Write through executor connections; ``num_partitions`` bounds how many are open."""
    out = df.coalesce(num_partitions) if num_partitions else df
    (out.write.format("jdbc").mode(mode).options(url=url, dbtable=table, batchsize=str(batch_size))
     .options(**(properties or {})).save())
