"""Window functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.operators import ordered as O
from tallgrass.operators import windows as W
from tallgrass.queries import query, read


def iso(name, col=None):
    return F.date_format(F.col(col or name), "yyyy-MM-dd").alias(name)


def monthly(spark, sf):
    """Exact monthly order value, one row per month."""
    month = F.trunc("o_orderdate", "MM").alias("month")
    return read(spark, sf, "orders").groupBy(month).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("sales"))


MONTHLY = "SELECT date_trunc('month', o_orderdate)::DATE AS month, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS sales FROM orders GROUP BY 1"


@query("SELECT p_partkey, p_name, p_retailprice, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS row_number FROM part")
def win_row_number(spark, sf):
    part = read(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    return O.row_number(part, [F.desc("p_retailprice"), F.asc("p_partkey")])


@query("""
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def win_latest_per_key(spark, sf):
    return W.latest_per_key(read(spark, sf, "orders"), ["o_custkey"], "o_orderdate", ["o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_totalprice")


@query("""
SELECT n_name, s_name, s_acctbal, rank() OVER (PARTITION BY n_name ORDER BY round(s_acctbal, -2) DESC) AS rank
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def win_rank_partition(spark, sf):
    supplier = read(spark, sf, "supplier").join(read(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    rated = supplier.withColumn("rate", F.round("s_acctbal", -2))
    return O.rank_by(rated, ["n_name"], "rate").select("n_name", "s_name", "s_acctbal", "rank")


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
       sum(o_totalprice::DECIMAL(18,2)) OVER (ORDER BY o_orderdate)::DOUBLE AS running FROM orders""")
def win_cumulative_sum(spark, sf):
    orders = read(spark, sf, "orders").select("o_orderkey", "o_orderdate", F.col("o_totalprice").cast("decimal(18,2)").alias("v"))
    return O.cumulative_sum(orders, "o_orderdate", "v", "running").select(
        "o_orderkey", iso("o_orderdate"), F.col("running").cast("double").alias("running"))


@query("""
WITH s AS (SELECT n_name, o_orderkey, o_orderdate::DATE AS day, o_totalprice::DECIMAL(18,2) AS v FROM orders
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
SELECT n_name, o_orderkey, strftime(day, '%Y-%m-%d') AS day, round((sum(v) OVER w)::DOUBLE / count(v) OVER w, 7) AS trailing_avg
FROM s WINDOW w AS (PARTITION BY n_name ORDER BY day RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW)""")
def win_range_days(spark, sf):
    """Every order beside the mean of its nation's orders of its day and the seven days before."""
    customer, nation = read(spark, sf, "customer"), read(spark, sf, "nation")
    sales = (read(spark, sf, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
             .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
             .select("n_name", "o_orderkey", F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").cast("decimal(18,2)").alias("v")))
    out = O.trailing_frame(sales, ["n_name"], "day", seconds=7 * 86_400, aggs={"trailing_avg": ("mean", "v")})
    return out.select("n_name", "o_orderkey", iso("day"), F.round("trailing_avg", 7).alias("trailing_avg"))


@query("""
SELECT event_id, event_type, (sum(value::DECIMAL(18,2)) OVER w)::DOUBLE AS week_total, count(*) OVER w AS week_events, max(value) OVER w AS week_peak
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW)""")
def win_range_time(spark, sf):
    """Every event beside the events of its type in the seven days up to its own instant."""
    events = read(spark, sf, "events").select("event_id", "event_type", "ts", "value", F.col("value").cast("decimal(18,2)").alias("v"))
    out = O.trailing_frame(events, ["event_type"], "ts", seconds=7 * 86_400, aggs={
        "week_total": ("sum", "v"), "week_events": ("count", "event_id"), "week_peak": ("max", "value")})
    return out.select("event_id", "event_type", F.col("week_total").cast("double").alias("week_total"), "week_events", "week_peak")


@query("""
SELECT event_id, user_id, round(sum(value::DECIMAL(18,2)) OVER w, 2)::DOUBLE AS last_five, max(value) OVER w AS peak
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""")
def win_rows_frame(spark, sf):
    events = read(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    out = O.rows_frame(events, ["user_id"], ["ts", "event_id"], 4, {
        "last_five": F.sum(F.col("value").cast("decimal(18,2)")), "peak": F.max("value")})
    return out.select("event_id", "user_id", F.col("last_five").cast("double").alias("last_five"), "peak")


@query("""SELECT o_orderkey, o_custkey, strftime(min(o_orderdate) OVER (PARTITION BY o_custkey), '%Y-%m-%d') AS first_order FROM orders""")
def win_group_transform(spark, sf):
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return W.group_value(orders, ["o_custkey"], F.min("o_orderdate"), "first_order").select(
        "o_orderkey", "o_custkey", iso("first_order"))


@query("""
SELECT c_mktsegment, c_nationkey, c_custkey FROM (SELECT *, row_number() OVER (
  PARTITION BY c_mktsegment, c_nationkey ORDER BY c_acctbal, c_custkey) AS rn FROM customer) WHERE rn = 1""")
def win_group_first_row(spark, sf):
    return W.first_rows(read(spark, sf, "customer"), ["c_mktsegment", "c_nationkey"], ["c_acctbal", "c_custkey"]).select(
        "c_mktsegment", "c_nationkey", "c_custkey")


@query("""
WITH s AS (SELECT p_brand, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS sales FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
SELECT p_brand, sales, round(avg(sales) OVER (), 4) AS average FROM s""")
def win_table_average(spark, sf):
    from tallgrass.operators.aggregates import beside_average

    per_part = read(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("v"))
    sales = per_part.join(read(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand").agg(
        F.sum("v").cast("double").alias("sales"))
    return beside_average(sales, "sales", "average").withColumn("average", F.round("average", 4))


@query(f"""
SELECT strftime(month, '%Y-%m-%d') AS month, sales, round(sales - lag(sales) OVER (ORDER BY month), 2) AS change FROM ({MONTHLY})""")
def win_lag_diff(spark, sf):
    return W.change(monthly(spark, sf), [], "month", "sales").select(iso("month"), "sales", F.round("change", 2).alias("change"))


@query(f"""
SELECT strftime(month, '%Y-%m-%d') AS month, CASE WHEN count(*) OVER w = 12 THEN round(avg(sales) OVER w, 4) END AS mean,
       CASE WHEN count(*) OVER w = 12 THEN round(stddev_samp(sales) OVER w, 2) END AS std
FROM ({MONTHLY}) WINDOW w AS (ORDER BY month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)""")
def win_rolling_mean_std(spark, sf):
    out = W.rolling(monthly(spark, sf), [], "month", "sales", periods=12,
                    fns={"mean": F.avg("sales"), "std": F.stddev_samp("sales")})
    return out.select(iso("month"), F.round("mean", 4).alias("mean"), F.round("std", 2).alias("std"))


@query(f"""
WITH m AS (SELECT *, row_number() OVER (ORDER BY month) AS t FROM ({MONTHLY}))
SELECT strftime(a.month, '%Y-%m-%d') AS month,
       round(sum(b.sales * 0.5 ** ((a.t - b.t) / 12.0)) / sum(0.5 ** ((a.t - b.t) / 12.0)), 2) AS ewma
FROM m a JOIN m b ON b.t <= a.t GROUP BY a.month""")
def win_ewma(spark, sf):
    return O.ewma(monthly(spark, sf), [], ["month"], "sales", halflife=12).select(iso("month"), F.round("ewma", 2).alias("ewma"))


@query("""
SELECT user_id, strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, sum(value::DECIMAL(18,2))::DOUBLE AS total, count(*) AS n
FROM events GROUP BY ALL""")
def time_tumbling(spark, sf):
    out = W.time_window_agg(read(spark, sf, "events"), ["user_id"], "ts", "1 day", None, [
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"), F.count(F.lit(1)).alias("n")])
    return out.select("user_id", F.date_format("window_start", "yyyy-MM-dd").alias("day"), "total", "n")


@query("""
SELECT event_type, strftime(date_trunc('day', ts) - k * INTERVAL 1 DAY, '%Y-%m-%d') AS window_start,
       strftime(date_trunc('day', ts) + (7 - k) * INTERVAL 1 DAY, '%Y-%m-%d') AS window_end,
       sum(value::DECIMAL(18,2))::DOUBLE AS total, count(*) AS n
FROM events, (SELECT unnest([0, 1, 2, 3, 4, 5, 6]) AS k) GROUP BY ALL""")
def time_sliding(spark, sf):
    """Seven-day windows starting every day; summed per day first, then spread."""
    daily = read(spark, sf, "events").groupBy("event_type", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("ts")).agg(
        F.sum(F.col("value").cast("decimal(18,2)")).alias("v"), F.count(F.lit(1)).alias("c"))
    out = W.time_window_agg(daily, ["event_type"], "ts", "7 days", "1 day", [
        F.sum("v").cast("double").alias("total"), F.sum("c").alias("n")])
    return out.select("event_type", iso("window_start"), iso("window_end"), "total", "n")
