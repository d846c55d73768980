"""Streams over the events table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallgrass.operators.windows import time_window_agg
from tallgrass.queries import query, read
from tallgrass.session import scratch_path
from tallgrass.streaming import files as S


def stream(spark, sf, **options):
    return S.stream_table(spark, f"{sf}/events.parquet", **options)


def daily(df):
    """The one transformation both the batch and the stream run."""
    return time_window_agg(df, ["user_id"], "ts", "1 day", None, [
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"), F.count(F.lit(1)).alias("n")])


def shown(df):
    return df.select("user_id", F.date_format("window_start", "yyyy-MM-dd").alias("day"), "total", "n")


_DAILY = "SELECT user_id, strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, sum(value::DECIMAL(18,2))::DOUBLE AS total, count(*) AS n FROM events GROUP BY ALL"


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_file_source(spark, sf):
    return S.run_available(stream(spark, sf).select("event_id", "user_id", "event_type", "value"), mode="append")


@query(_DAILY)
def stream_tumbling_agg(spark, sf):
    return shown(S.run_available(daily(stream(spark, sf))))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def stream_sink_complete(spark, sf):
    """Complete-mode counts, read by the name of their view."""
    counts = stream(spark, sf).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return S.run_to_view(counts, f"by_type_{uuid.uuid4().hex}")


@query("SELECT event_id, value FROM events")
def stream_once_checkpoint(spark, sf):
    """Two runs on one checkpoint: the second finds only the files added in between."""
    folder, out, checkpoint = (scratch_path(spark, n) for n in ("arriving", "arrived", "progress"))
    events = read(spark, sf, "events").select("event_id", "ts", "value")
    middle = F.lit("2024-01-15").cast("timestamp_ntz")
    for early in (True, False):
        part = events.where(F.col("ts") < middle) if early else events.where(F.col("ts") >= middle)
        part.write.mode("append").parquet(folder)
        S.run_available(S.stream_files(spark, folder, max_files=4), mode="append", checkpoint=checkpoint, output=out)
    return spark.read.parquet(out).select("event_id", "value")


@query(f"SELECT count(*) AS rows_equal, 0::BIGINT AS only_stream, 0::BIGINT AS only_batch FROM ({_DAILY})")
def stream_batch_parity(spark, sf):
    streamed, batch = shown(S.run_available(daily(stream(spark, sf)))), shown(daily(read(spark, sf, "events")))
    same = streamed.withColumn("s", F.lit(1)).join(batch.withColumn("b", F.lit(1)), ["user_id", "day", "total", "n"], "full")
    return same.agg(F.count_if(F.col("s").isNotNull() & F.col("b").isNotNull()).alias("rows_equal"),
                    F.count_if(F.col("b").isNull()).alias("only_stream"), F.count_if(F.col("s").isNull()).alias("only_batch"))
