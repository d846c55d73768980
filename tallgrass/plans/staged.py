"""Stored tables cut into parts, changed by staged writes and a swap.

Below a folder, ``data/load=<id>/_part=<n>`` holds the rows of a part as one load left them, and
``manifest/version=<n>`` names the load that each part stands at. A load writes new folders for
the parts it changes, beside the old ones, and then the next manifest, a single file: until that
is there readers see the table as it was, and parts not touched are never written again.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_MANIFEST = "version long, part int, load string"


def by_hash(keys: list[str], parts: int) -> Column:
    """Part of a row by a hash of its keys: loads of any keys touch parts evenly."""
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")


def by_range(key: str, width: int) -> Column:
    """Part of a row by ranges of a whole-number key: loads of neighbouring keys touch few parts."""
    return F.floor(F.col(key) / width).cast("int")


def by_month(date: str) -> Column:
    """Part of a row by the month of a date, which must be part of the key."""
    return (F.year(date) * 100 + F.month(date)).cast("int")


def _manifest(spark: SparkSession, folder: str) -> tuple[int, dict[int, str]]:
    """Newest version and the load of each part; one row a part is read."""
    try:
        rows = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, {}
    newest = rows.agg(F.max("version")).first()[0]
    return (0, {}) if newest is None else (newest, {r.part: r.load for r in rows.where(F.col("version") == newest).collect()})


def _stored(spark: SparkSession, folder: str, schema, loads: dict[int, str]) -> DataFrame:
    if not loads:
        return spark.createDataFrame([], schema)
    paths = [f"{folder}/data/load={load}/_part={part}" for part, load in sorted(loads.items())]
    return spark.read.schema(schema).parquet(*paths)


def read_staged(spark: SparkSession, folder: str, schema) -> DataFrame:
    """The table as its newest version has it."""
    return _stored(spark, folder, schema, _manifest(spark, folder)[1])


def upsert_staged(source: DataFrame, folder: str, keys: list[str], part: Column, *, view: str | None = None) -> list[int]:
    """Merge ``source`` into the table in ``folder``: update matched keys, insert the others; the parts rewritten.

    ``source`` holds one row per key and all columns of the table; ``part`` is an expression over
    the keys, always the same one for a folder. Only parts with a row that is new or other than
    stored are read in full, merged and written; a load that comes again changes nothing. The
    number of parts, which the driver lists, is the caller's choice.

    ``view`` is pointed at the new version when that is complete.
    """
    spark, schema = source.sparkSession, source.schema
    version, loads = _manifest(spark, folder)
    placed = source.withColumn("_part", part)
    asked = {p: loads[p] for (p,) in placed.select("_part").distinct().collect() if p in loads}
    if asked:
        old = _stored(spark, folder, schema, asked)
        row = F.struct(*source.columns)
        before = old.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], row.alias("_old"))
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
        changed = placed.join(before, same, "left").where(F.col("_old").isNull() | ~row.eqNullSafe(F.col("_old")))
        touched = sorted(r[0] for r in changed.select("_part").distinct().collect())
    else:
        touched = sorted(r[0] for r in placed.select("_part").distinct().collect())
    if touched:
        load = uuid.uuid4().hex
        new = placed.where(F.col("_part").isin(touched))
        kept = {p: asked[p] for p in touched if p in asked}
        if kept:
            given = new.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
            new = _stored(spark, folder, schema, kept).withColumn("_part", part).join(given, same, "left_anti").unionByName(new)
        new.repartition("_part").write.mode("error").partitionBy("_part").parquet(f"{folder}/data/load={load}")
        loads = loads | dict.fromkeys(touched, load)
        rows = spark.createDataFrame(sorted(loads.items()), "part int, load string")
        rows.coalesce(1).write.mode("error").parquet(f"{folder}/manifest/version={version + 1}")
    if view:
        _stored(spark, folder, schema, loads).createOrReplaceTempView(view)
    return touched
