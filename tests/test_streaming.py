import os

import pytest
from pyspark.sql import functions as F

from tallgrass.operators.windows import time_window_agg
from tallgrass.session import scratch_path
from tallgrass.streaming import files as S
from tests.util import rows


@pytest.fixture(scope="module")
def folder(spark):
    path = scratch_path(spark, "events")
    df = spark.range(300).selectExpr("id", "id % 4 AS user", "timestamp_micros(1704067200000000 + id * 1800000000) AS ts", "id * 1.5 AS v")
    df.repartition(5).write.parquet(path)
    return path


def daily(df):
    return time_window_agg(df, ["user"], "ts", "1 day", None, [F.sum("v").alias("total"), F.count("v").alias("n")])


def test_stream_equals_batch(spark, folder):
    streamed = S.run_available(daily(S.stream_files(spark, folder)))
    assert rows(streamed) == rows(daily(spark.read.parquet(folder)))


def test_named_result(spark, folder):
    counts = S.stream_files(spark, folder, max_files=2).groupBy("user").count()
    assert rows(S.run_to_view(counts, "stream_counts")) == [(0, 75), (1, 75), (2, 75), (3, 75)]


def test_checkpoint_reads_a_file_once(spark):
    arriving, out, progress = (scratch_path(spark, n) for n in ("in", "out", "cp"))
    for i in range(2):
        spark.range(i * 10, i * 10 + 10).write.mode("append").parquet(arriving)
        S.run_available(S.stream_files(spark, arriving, schema="id long"), mode="append", checkpoint=progress, output=out)
    assert rows(spark.read.parquet(out)) == sorted([(i,) for i in range(20)], key=str)
    counts = S.stream_files(spark, arriving, max_files=1).groupBy().count()
    cp, kept = scratch_path(spark, "cp2"), scratch_path(spark, "kept")
    for _ in range(2):  # nothing is new in the second run: the first one's result, and no other folder
        assert rows(S.run_available(counts, checkpoint=cp, output=kept)) == [(20,)]
        assert len([n for n in os.listdir(kept) if n.startswith("batch=")]) == 1
    with pytest.raises(ValueError):
        S.run_available(counts, checkpoint=cp)


def test_append_needs_and_uses_a_watermark(spark, folder):
    df = S.stream_files(spark, folder, max_files=10, watermark=("ts", "1 hour"))
    got = S.run_available(daily(df), mode="append")
    want = daily(spark.read.parquet(folder))
    assert got.join(want, ["user", "window_start", "total", "n"], "left_anti").count() == 0
    assert 0 < got.count() <= want.count()


def test_each_batch_sees_every_row(spark, folder):
    target = scratch_path(spark, "batches")
    S.run_each_batch(S.stream_files(spark, folder, max_files=2),
                     lambda b, i: b.write.mode("overwrite").parquet(f"{target}/b={i}"), checkpoint=scratch_path(spark, "cp"))
    assert spark.read.parquet(target).count() == 300
