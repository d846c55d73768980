"""File streams: the same transformations as batch, run until the input is used up.

State grows with the number of keys and windows in ``complete`` mode, which drops no
late row; pass a watermark and use ``append`` to bound it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallgrass.session import scratch_path


def stream_files(spark: SparkSession, path: str, *, schema: StructType | str | None = None, fmt: str = "parquet",
                 max_files: int | None = None, pattern: str | None = None, watermark: tuple[str, str] | None = None) -> DataFrame:
    """Unbounded frame over the files of a folder; the schema of a batch read if none is given.

    A trigger takes all files there are unless ``max_files`` bounds it.
    """
    options = {"pathGlobFilter": pattern} if pattern else {}
    if schema is None:
        schema = spark.read.format(fmt).options(**options).load(path).schema
    if max_files:
        options["maxFilesPerTrigger"] = str(max_files)
    df = spark.readStream.format(fmt).schema(schema).options(**options).load(path)
    return df.withWatermark(*watermark) if watermark else df


def stream_table(spark: SparkSession, path: str, **options) -> DataFrame:
    """Stream one table, stored as a folder of files or as a single file."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(hadoop).isDirectory():
        return stream_files(spark, path, **options)
    folder, name = path.rsplit("/", 1)
    return stream_files(spark, folder, pattern=name, **options)


def run_available(df: DataFrame, *, mode: str = "complete", checkpoint: str | None = None, output: str | None = None) -> DataFrame:
    """Process everything now available, then stop; returns the result as a batch frame.

    The result goes to files, never through driver memory. In complete mode every
    trigger writes the whole result to a folder named by its batch, so a repeated
    batch rewrites its own folder; the newest one is returned and the others of this
    run go. Without new files that is the newest one of an earlier run into the same
    ``output``. In append mode the file sink adds each batch exactly once.
    """
    spark = df.sparkSession
    output = output or scratch_path(spark, "stream-out")
    checkpoint = checkpoint or scratch_path(spark, "stream-checkpoint")
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        _finish(writer.format("parquet").start(output))
        return spark.read.schema(df.schema).parquet(output)

    fs, folder = _folder(spark, output)
    written: list[int] = []

    def at(batch_id: int) -> str:
        return f"batch={batch_id:09d}"

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/{at(batch_id)}")
        if written and written[-1] != batch_id:
            fs.delete(folder(at(written[-1])), True)
        written.append(batch_id)

    _finish(writer.foreachBatch(write).start())
    if written:
        return spark.read.parquet(f"{output}/{at(written[-1])}")
    names = [s.getPath().getName() for s in fs.listStatus(folder("."))] if fs.exists(folder(".")) else []
    done = sorted(n for n in names if n.startswith("batch=") and fs.exists(folder(f"{n}/_SUCCESS")))
    if not done:
        raise ValueError("no new files since the checkpoint, and no earlier result in the output folder")
    return spark.read.parquet(f"{output}/{done[-1]}")


def run_to_view(df: DataFrame, name: str, *, mode: str = "complete", checkpoint: str | None = None,
                output: str | None = None) -> DataFrame:
    """Result under a name for SQL, of any size: a view of the written files, not driver memory."""
    run_available(df, mode=mode, checkpoint=checkpoint, output=output).createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def run_each_batch(df: DataFrame, action: Callable[[DataFrame, int], None], *, checkpoint: str) -> None:
    """Hand every micro-batch with its id to an action; make it idempotent by the id."""
    _finish(df.writeStream.foreachBatch(action).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def _folder(spark: SparkSession, root: str):
    """File system of a folder, and a function that names paths below it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    base = path(root)
    return base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), lambda name: base if name == "." else path(base, name)


def _finish(run) -> None:
    run.awaitTermination()
    problem = run.exception()
    if problem is not None:
        raise problem
