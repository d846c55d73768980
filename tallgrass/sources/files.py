"""File readers and writers. Options are keyword-only; nothing is cached or collected."""

from __future__ import annotations

import re
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallgrass.operators.columns import sanitize_columns

SAVE_MODES = ("append", "overwrite", "ignore", "error")


def read_csv(spark: SparkSession, path, *, schema: StructType | str | None = None,
             header: bool = True, sep: str = ",", multi_line: bool = False) -> DataFrame:
    """CSV with a given schema, or with inferred types (one extra pass) if none is given."""
    reader = spark.read.option("header", header).option("sep", sep).option("multiLine", multi_line)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_json(spark: SparkSession, path, *, schema: StructType | str | None = None,
              multi_line: bool = False) -> DataFrame:
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_parquet(spark: SparkSession, path) -> DataFrame:
    return spark.read.parquet(path)


def read_orc(spark: SparkSession, path) -> DataFrame:
    return spark.read.orc(path)


def read_text(spark: SparkSession, path) -> DataFrame:
    return spark.read.text(path)


def read_avro(spark: SparkSession, path) -> DataFrame:
    """Needs the external spark-avro module on the classpath."""
    return spark.read.format("avro").load(path)


def write_csv(df: DataFrame, path: str, *, mode: str = "error", sep: str = ",", header: bool = True,
              encoding: str = "UTF-8", compression: str | None = None,
              partition_by: Iterable[str] = ()) -> None:
    writer = df.write.mode(_mode(mode)).option("sep", sep).option("header", header)
    writer = writer.option("encoding", encoding)
    if compression:
        writer = writer.option("compression", compression)
    partition_by = list(partition_by)
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


def write_files(df: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "error",
                partition_by: Iterable[str] = ()) -> None:
    writer = df.write.format(fmt).mode(_mode(mode))
    partition_by = list(partition_by)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def _mode(mode: str) -> str:
    if mode not in SAVE_MODES:
        raise ValueError(f"unknown save mode {mode!r}; use one of {SAVE_MODES}")
    return mode


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> list[str]:
    """Files directly below ``folder``; works for any file system Spark can read."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{pattern}")
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(hadoop) or []
    return sorted(s.getPath().toString() for s in found if s.isFile())


def table_name_of(path: str) -> str:
    stem = re.sub(r"\.[A-Za-z0-9]+$", "", path.rstrip("/").rsplit("/", 1)[-1])
    return re.sub(r"[^0-9A-Za-z]+", "_", stem).strip("_").lower()


def ingest_folder(spark: SparkSession, folder: str, *, pattern: str = "*.csv", parallel: int = 8):
    """Every matching CSV as a frame with clean column names.

    Returns ``(frames, problems)``: files without columns are skipped and a file
    that cannot be read is reported without stopping the others. The threads only
    submit Spark work; the rows stay on the executors.
    """

    def load(path: str):
        try:
            df = read_csv(spark, path)
            return path, (sanitize_columns(df) if df.columns else None), None
        except Exception as exc:  # one bad file must not stop the load
            return path, None, f"{type(exc).__name__}: {exc}"

    frames, problems = {}, {}
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        for path, df, problem in pool.map(load, list_files(spark, folder, pattern)):
            if problem:
                problems[path] = problem
            elif df is not None:
                base = name = table_name_of(path)
                extra = 2
                while name in frames:  # files whose names clean to the same one are all kept
                    name, extra = f"{base}_{extra}", extra + 1
                frames[name] = df
    return frames, problems


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def copy_into(spark: SparkSession, target: str, paths: list[str], *, parallel: int = 8,
              schema: StructType | str | None = None) -> list[str]:
    """Load CSV files not loaded before into a Parquet folder, whatever columns each has.

    Every file has its own subfolder, named by the hash of its path and overwritten
    as a whole, so a load that broke off is simply repeated and a finished one is
    skipped. Values stay strings unless a schema is given. Returns the files loaded.
    """

    def load(path: str) -> str | None:
        out = f"{target}/source_id={md5(path.encode()).hexdigest()}"
        if _exists(spark, f"{out}/_SUCCESS"):
            return None
        reader = spark.read.option("header", True)
        if schema is not None:
            reader = reader.schema(schema)
        reader.csv(path).withColumn("source_file", F.lit(path)).write.mode("overwrite").parquet(out)
        return path

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return [p for p in pool.map(load, dict.fromkeys(paths)) if p]


def read_copied(spark: SparkSession, target: str) -> DataFrame:
    """Frame loaded by :func:`copy_into`, columns of all files merged by name."""
    return spark.read.option("mergeSchema", True).parquet(target)


def complete_snapshots(spark: SparkSession, root: str, required_files: Iterable[str]) -> list[str]:
    """Dates of the ``root/<date>/`` folders that hold every required file."""
    required = set(required_files)
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{root}/*/*")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    held: dict[str, set[str]] = {}
    for status in fs.globStatus(pattern) or []:
        path = status.getPath()
        held.setdefault(path.getParent().getName(), set()).add(path.getName())
    return sorted(d for d, names in held.items()
                  if re.fullmatch(r"\d{4}-\d{2}-\d{2}", d) and required <= names)


def read_snapshots(spark: SparkSession, root: str, file_name: str, dates: list[str], *,
                   schema: StructType | str | None = None) -> DataFrame:
    """One file of each given snapshot, with the folder's date as ``snapshot_date``."""
    df = read_csv(spark, [f"{root}/{d}/{file_name}" for d in dates], schema=schema)
    date = F.regexp_extract(F.input_file_name(), r"/(\d{4}-\d{2}-\d{2})/", 1)
    return df.withColumn("snapshot_date", F.to_date(date))
