"""Session helpers: shared scratch storage, lineage cuts, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a ``local`` master may fall back to a folder of its own; on a cluster a
    missing setting is an error rather than a silent machine-local path.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="tallgrass-")
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def scratch_path(spark: SparkSession, label: str) -> str:
    """Fresh path below the shared folder; never reused between runs."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to shared storage and continue from the written copy."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def settled(df: DataFrame, id_col: str) -> DataFrame:
    """``df`` written once, dealt by its id and sorted by it: the same layout, however the rows lay before."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(df.repartition(parts, id_col).sortWithinPartitions(id_col))


def dealt(df: DataFrame, keys: list[str], rows: int, *, each: int = 200_000) -> DataFrame:
    """``df`` of about ``rows`` rows dealt by ``keys``, about ``each`` to a task.

    The number of parts goes by the rows and is kept by adaptive execution, so what a task holds
    doesn't grow with the input. Equal keys stay together: not for keys that many rows share.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-rows // each)), *keys)


def estimated_bytes(df: DataFrame) -> int:
    """Size of ``df`` as the optimizer estimates it, from files and row widths; runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_checked(df: DataFrame, max_bytes: int = 10 << 20) -> DataFrame:
    """Broadcast hint if the estimated size allows it; any other side is left to Spark."""
    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df


def lookup(df: DataFrame) -> DataFrame:
    """``df`` as the lesser side of a join: broadcast if the estimated size allows it, else hashed per task, so the greater side isn't sorted."""
    small = broadcast_checked(df)
    return df.hint("shuffle_hash") if small is df else small
