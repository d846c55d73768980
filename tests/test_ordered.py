"""Ordered operators against pandas, with a key that holds a third of all rows."""

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallgrass.operators import ordered as O
from tests.util import plan


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(3)
    n = 3000
    key = np.where(np.arange(n) < n // 3, "hot", np.char.add("k", (rng.integers(0, 40, n)).astype(str)))
    pdf = pd.DataFrame({"id": np.arange(n), "key": key, "day": rng.integers(0, 25, n), "v": rng.integers(-50, 50, n)})
    pdf.loc[pdf["id"] % 97 == 0, "key"] = None
    return pdf, spark.createDataFrame(pdf).replace("NaN", None).repartition(8).cache()


def test_positions_are_dense_and_ordered(skewed):
    pdf, df = skewed
    got = O.with_position(df, [F.desc("v"), F.asc("id")]).toPandas().sort_values("position")
    want = pdf.sort_values(["v", "id"], ascending=[False, True])
    assert got["position"].tolist() == list(range(len(pdf)))
    assert got["id"].tolist() == want["id"].tolist()


def test_row_number_by_key(skewed):
    pdf, df = skewed
    got = O.row_number_by(df, ["key"], [F.asc("day"), F.asc("id")]).toPandas().set_index("id")["row_number"]
    ordered = pdf.fillna({"key": "<null>"}).sort_values(["day", "id"])
    want = ordered.groupby("key").cumcount() + 1
    assert got.sort_index().tolist() == want.sort_index().tolist()


def test_running_total_carries_across_tasks(skewed):
    pdf, df = skewed
    got = O.running_total(df, ["key"], [F.asc("id")], "v", "total").toPandas().set_index("id")["total"].sort_index()
    want = pdf.fillna({"key": "<null>"}).groupby("key")["v"].cumsum()
    assert got.tolist() == want.tolist()


def test_running_total_of_one_group_only(spark):
    df = spark.range(1000).withColumn("v", F.lit(1))
    got = O.running_total(df, [], [F.asc("id")], "v", "total")
    assert got.where("total <> id + 1").count() == 0


def test_cumulative_sum_shares_ties(skewed):
    pdf, df = skewed
    got = O.cumulative_sum(df, "day", "v", "total").toPandas().set_index("id")["total"].sort_index()
    per_day = pdf.groupby("day")["v"].sum().cumsum()
    assert got.tolist() == pdf["day"].map(per_day).tolist()


def test_rank_keeps_ties_together(skewed):
    pdf, df = skewed
    got = O.rank_by(df, ["key"], "v").toPandas().set_index("id")["rank"].sort_index()
    want = pdf.fillna({"key": "<null>"}).groupby("key")["v"].rank(method="min", ascending=False).astype(int)
    assert got.tolist() == want.tolist()


@pytest.mark.parametrize("block", [4, 7, 65536])
def test_rows_frame_does_not_depend_on_blocks(skewed, block):
    pdf, df = skewed
    got = O.rows_frame(df, ["key"], [F.asc("id")], 4, {"s": F.sum("v"), "n": F.count("v")}, block=block)
    got = got.toPandas().set_index("id").sort_index()
    grouped = pdf.fillna({"key": "<null>"}).groupby("key")["v"]
    assert got["s"].tolist() == grouped.transform(lambda x: x.rolling(5, min_periods=1).sum()).astype(int).tolist()
    assert len(got) == len(pdf)


def test_exact_quantiles_match_pandas(skewed):
    pdf, df = skewed
    probs = {"a": 0.01, "b": 0.5, "c": 0.9, "d": 1.0}
    got = O.exact_quantiles(df, ["key"], "v", probs).toPandas().fillna({"key": "<null>"}).set_index("key").sort_index()
    want = pdf.fillna({"key": "<null>"}).groupby("key")["v"].quantile(list(probs.values())).unstack()
    assert np.allclose(got[list(probs)].to_numpy(), want.sort_index().to_numpy())
    whole = O.exact_quantiles(df, [], "v", probs).first()
    assert np.allclose(list(whole), pdf["v"].quantile(list(probs.values())))


def test_approx_quantiles_are_near_the_exact_ranks(skewed):
    pdf, df = skewed
    got = O.approx_quantiles(df, [], "v", {"a": 0.1, "b": 0.5}, accuracy=200).first()
    v = pdf["v"].dropna()
    for p, x in zip((0.1, 0.5), got, strict=True):
        assert (v < x).mean() - 0.01 <= p <= (v <= x).mean() + 0.01


def test_empty_input(spark):
    empty = spark.createDataFrame([], "id int, key string, v int")
    assert O.with_position(empty, ["id"]).count() == 0
    assert O.running_total(empty, ["key"], ["id"], "v", "t").count() == 0
    assert O.rank_by(empty, ["key"], "v").count() == 0
    assert O.exact_quantiles(empty, ["key"], "v", {"q": 0.5}).count() == 0


def test_running_total_and_ewma_keep_nulls(spark):
    values = [None, None, 5.0, None, 3.0, 1.0, None]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "k string, i int, v double").repartition(4, "i")
    got = [r.t for r in O.running_total(df, ["k"], [F.col("i")], "v", "t").orderBy("i").collect()]
    assert got == [None, None, 5.0, 5.0, 8.0, 9.0, 9.0]
    want = pd.Series(values, dtype="float64").ewm(halflife=1).mean()
    mean = [r.m for r in O.ewma(df, ["k"], ["i"], "v", halflife=1, name="m").orderBy("i").collect()]
    assert [m is None for m in mean] == list(want.isna()) and all(abs(m - w) < 1e-9 for m, w in zip(mean, want) if m is not None)


@pytest.mark.parametrize("halflife", [0.01, 3, 12, 1e7])
def test_ewma_of_series_over_many_tasks(spark, halflife):
    """A key in most tasks, small ones beside it, nulls at the start, in between and for longer than weights last."""
    rng = np.random.default_rng(3)
    sizes = {"a": 5, "hot": 30_000, "z": 40, None: 7}
    pdf = pd.concat([pd.DataFrame({"k": k, "t": range(n), "v": rng.normal(50, 20, n)}) for k, n in sizes.items()], ignore_index=True)
    pdf.loc[rng.random(len(pdf)) < 0.1, "v"] = np.nan
    hot = pdf.k == "hot"
    pdf.loc[hot & (pdf.t < 50), "v"] = np.nan
    pdf.loc[hot & (pdf.t > 8_000) & (pdf.t < 22_000), "v"] = np.nan
    df = spark.createDataFrame(pdf, "k string, t int, v double").replace(float("nan"), None).repartition(5)
    got = O.ewma(df, ["k"], ["t"], "v", halflife=halflife).toPandas()
    assert len(got) == len(pdf)
    for k, part in pdf.groupby("k", dropna=False):
        mine = got[got.k.isna() if pd.isna(k) else got.k == k].sort_values("t")["ewma"].to_numpy(float)
        want = part.v.ewm(halflife=halflife).mean().to_numpy()
        assert np.array_equal(np.isnan(mine), np.isnan(want)) and np.allclose(mine, want, rtol=1e-9, equal_nan=True)


def test_ewma_of_a_million_rows(spark):
    df = spark.range(1_000_000).selectExpr("id", "pmod(xxhash64(id), 1000) / 10.0 AS v")
    out = O.ewma(df, [], ["id"], "v", halflife=100)
    assert "collect_list" not in plan(out)
    got = out.orderBy("id").toPandas()
    assert np.allclose(got["ewma"], got["v"].astype(float).ewm(halflife=100).mean(), rtol=1e-9)


def brute_frame(pdf, width):
    out = []
    for r in pdf.itertuples():
        same = pdf[pdf.k.isna() if r.k is None else pdf.k == r.k]
        if pd.isna(r.t):
            part = same[same.t.isna()]
        else:
            part = same[(same.t <= r.t) & (same.t >= r.t - pd.Timedelta(seconds=width))]
        v = part.v.dropna()
        out.append((r.id, len(v), round(v.sum(), 6) if len(v) else None, round(v.mean(), 6) if len(v) else None, v.min() if len(v) else None, v.max() if len(v) else None))
    return sorted(out)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_trailing_frame_is_each_rows_own(spark, kind):
    rng = np.random.default_rng(1)
    n, width = 600, 3 * 86_400
    t = pd.Timestamp("1969-12-20") + pd.to_timedelta(rng.integers(0, 40 * 86_400_000_000, n), "us")
    t = (t.floor("D") if kind == "date" else t).to_series().reset_index(drop=True)
    t[:50] = t[50:100].to_numpy() + (np.timedelta64(width, "s") if kind != "date" else np.timedelta64(3, "D"))  # just within the frame
    t[rng.random(n) < 0.02] = pd.NaT
    pdf = pd.DataFrame({"id": range(n), "k": rng.choice(["hot", "hot", "hot", "b", None], n), "t": t, "v": rng.integers(0, 1000, n) / 8})
    pdf["k"] = pdf.k.astype(object).where(pdf.k.notna(), None)
    pdf.loc[rng.random(n) < 0.1, "v"] = np.nan
    texts = [(r.id, r.k, None if pd.isna(r.t) else str(r.t), None if np.isnan(r.v) else r.v) for r in pdf.itertuples()]
    df = spark.createDataFrame(texts, "id long, k string, t string, v double").withColumn("t", F.col("t").cast(kind))
    out = O.trailing_frame(df, ["k"], "t", seconds=width, aggs={"n": ("count", "v"), "s": ("sum", "v"), "m": ("mean", "v"), "lo": ("min", "v"), "hi": ("max", "v")})
    assert out.columns == ["id", "k", "t", "v", "n", "s", "m", "lo", "hi"]
    got = sorted((r.id, r.n, None if r.s is None else round(r.s, 6), None if r.m is None else round(r.m, 6), r.lo, r.hi) for r in out.collect())
    assert got == brute_frame(pdf, width)


def test_trailing_frame_splits_a_hot_key(spark):
    """A key of all rows over many frame widths: no window group holds more than a few widths of it."""
    df = spark.range(20_000).selectExpr("concat('hot', id % 1) AS k", "id", "timestamp_seconds(id * 60) AS t")
    out = O.trailing_frame(df, ["k"], "t", seconds=3600, aggs={"n": ("count", "id")})
    text = plan(out)
    assert re.search(r"hashpartitioning\(k#\w+, _block#", text)
    assert {r.n: r["count"] for r in out.groupBy("n").count().collect()}[61] == 20_000 - 60
