"""Time series over the order values."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.plans import timeseries as T
from tallgrass.queries import query, read


def iso(col):
    return F.date_format(col, "yyyy-MM-dd").alias(col)


def monthly(spark, sf):
    """Mean daily order value per month, exact to the cent before the mean."""
    orders = read(spark, sf, "orders").select("o_orderdate", F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    return T.monthly_mean(orders, [], "o_orderdate", "amount")


def by_segment(spark, sf):
    joined = read(spark, sf, "orders").join(read(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy(F.col("c_mktsegment").alias("segment"), F.trunc("o_orderdate", "MM").alias("month")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("value"))


MONTHLY = """(SELECT date_trunc('month', day)::DATE AS month, sum(total)::DOUBLE / count(*) AS value FROM (
  SELECT o_orderdate::DATE AS day, sum(o_totalprice::DECIMAL(18,2)) AS total FROM orders GROUP BY 1) GROUP BY 1)"""
SEGMENTS = """(SELECT c_mktsegment AS segment, date_trunc('month', o_orderdate)::DATE AS month, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS value
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""


@query(f"SELECT strftime(month, '%Y-%m-%d') AS month, round(value, 5) AS value FROM {MONTHLY}")
def ts_monthly_mean(spark, sf):
    return monthly(spark, sf).select(iso("month"), F.round("value", 5).alias("value"))


@query(f"""
WITH m AS (SELECT segment, month, ln(value) AS v, row_number() OVER (PARTITION BY segment ORDER BY month) AS t FROM {SEGMENTS}),
e AS (SELECT a.segment, a.month, sum(b.v * 0.5 ** ((a.t - b.t) / 12.0)) / sum(0.5 ** ((a.t - b.t) / 12.0)) AS ewma
  FROM m a JOIN m b ON a.segment = b.segment AND b.t <= a.t GROUP BY ALL)
SELECT segment, strftime(month, '%Y-%m-%d') AS month, round(v, 6) AS log_value,
  CASE WHEN t >= 12 THEN round(v - avg(v) OVER (PARTITION BY segment ORDER BY month ROWS 11 PRECEDING), 6) END AS less_mean,
  round(v - ewma, 6) AS less_ewma, round(v - lag(v) OVER (PARTITION BY segment ORDER BY month), 6) AS log_change FROM m JOIN e USING (segment, month)""")
def ts_log_detrend(spark, sf):
    out = T.log_detrend(by_segment(spark, sf), ["segment"], "month", "value")
    return out.select("segment", iso("month"), *[F.round(c, 6).alias(c) for c in ("log_value", "less_mean", "less_ewma", "log_change")])


@query(f"""
WITH m AS (SELECT *, row_number() OVER w - 1 AS t, count(*) OVER (PARTITION BY segment) AS n FROM {SEGMENTS} WINDOW w AS (PARTITION BY segment ORDER BY month)),
tr AS (SELECT *, CASE WHEN t >= 6 AND t < n - 6 THEN (0.5 * lag(value, 6) OVER w + 0.5 * lead(value, 6) OVER w
  + sum(value) OVER (PARTITION BY segment ORDER BY month ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)) / 12 END AS trend
  FROM m WINDOW w AS (PARTITION BY segment ORDER BY month)),
s AS (SELECT segment, t % 12 AS phase, avg(value - trend) AS mean FROM tr GROUP BY ALL),
c AS (SELECT segment, phase, mean - avg(mean) OVER (PARTITION BY segment) AS seasonal FROM s)
SELECT tr.segment, strftime(month, '%Y-%m-%d') AS month, round(trend, 5) AS trend, round(seasonal, 5) AS seasonal,
  round(value - trend - seasonal, 5) AS residual FROM tr JOIN c ON tr.segment = c.segment AND tr.t % 12 = c.phase""")
def ts_decompose(spark, sf):
    out = T.decompose_additive(by_segment(spark, sf), ["segment"], "month", "value")
    return out.select("segment", iso("month"), *[F.round(c, 5).alias(c) for c in ("trend", "seasonal", "residual")])


def _box(part):
    return f"""SELECT '{part}' AS part, {part}(month)::INT AS at, round(min(value), 6) AS low, round(quantile_cont(value, 0.25), 6) AS q1,
      round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q3, round(max(value), 6) AS high FROM {MONTHLY} GROUP BY 2"""


@query(_box("year") + " UNION ALL " + _box("month"))
def ts_box_by_period(spark, sf):
    months = monthly(spark, sf)

    def one(part, col):
        out = T.box_figures(months, [col.alias("at")], "value")
        return out.select(F.lit(part).alias("part"), "at", *[F.round(c, 6).alias(c) for c in ("low", "q1", "median", "q3", "high")])

    return one("year", F.year("month")).unionByName(one("month", F.month("month")))


@query(f"""
WITH p AS (SELECT segment, lag(value) OVER w AS x, value - lag(value) OVER w AS y FROM {SEGMENTS} WINDOW w AS (PARTITION BY segment ORDER BY month)),
s AS (SELECT segment, count(y) AS n_obs, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy FROM p WHERE x IS NOT NULL GROUP BY 1),
t AS (SELECT segment, n_obs, (sxy / sxx) / sqrt((syy - sxy * sxy / sxx) / (n_obs - 2) / sxx) AS statistic FROM s)
SELECT segment, n_obs, round(statistic, 6) AS statistic, statistic < -3.43 AS stationary_1, statistic < -2.86 AS stationary_5, statistic < -2.57 AS stationary_10 FROM t""")
def ts_dickey_fuller(spark, sf):
    return T.dickey_fuller(by_segment(spark, sf), ["segment"], "month", "value").withColumn("statistic", F.round("statistic", 6))


@query(f"""SELECT segment, strftime(month, '%Y-%m-%d') AS month, CASE WHEN row_number() OVER (PARTITION BY segment ORDER BY month) <= 42 THEN 'train' ELSE 'test' END AS split FROM {SEGMENTS}""")
def ts_split(spark, sf):
    return T.split_series(by_segment(spark, sf), ["segment"], "month", train=42).select("segment", iso("month"), "split")


_NAIVE = f"""
WITH m AS (SELECT * FROM {SEGMENTS}), e AS (SELECT segment, max(month) AS fin FROM m GROUP BY 1),
st AS (SELECT segment, month, value, value - lag(value, 12) OVER w AS step, row_number() OVER (PARTITION BY segment ORDER BY month DESC) AS back FROM m
  WINDOW w AS (PARTITION BY segment ORDER BY month)),
d AS (SELECT segment, avg(step) AS drift FROM st GROUP BY 1),
h AS (SELECT unnest(range(1, 14)) AS step)
SELECT st.segment, h.step::INT AS step, (fin + to_months(h.step::INT))::DATE AS month, value + ceil(h.step / 12) * drift AS forecast
FROM st JOIN e USING (segment) JOIN d USING (segment) JOIN h ON (h.step - 1) % 12 = 12 - back WHERE back <= 12"""


@query(f"SELECT segment, step, strftime(month, '%Y-%m-%d') AS month, round(forecast, 3) AS forecast FROM ({_NAIVE})")
def ts_forecast(spark, sf):
    out = T.forecast(by_segment(spark, sf), ["segment"], "month", "value", horizon=13)
    return out.select("segment", "step", iso("month"), F.round("forecast", 3).alias("forecast"))


_AR = f"""
WITH RECURSIVE m AS (SELECT segment, month, value, row_number() OVER (PARTITION BY segment ORDER BY month) AS i, count(*) OVER (PARTITION BY segment) AS n FROM {SEGMENTS}),
d AS (SELECT *, value - lag(value, 12) OVER (PARTITION BY segment ORDER BY i) AS y FROM m),
l AS (SELECT *, lag(y, 1) OVER w AS a, lag(y, 2) OVER w AS b FROM d WINDOW w AS (PARTITION BY segment ORDER BY i)),
s AS (SELECT segment, avg(y) AS my, avg(a) AS ma, avg(b) AS mb, var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay,
  covar_pop(b, y) AS by_ FROM l WHERE y IS NOT NULL AND a IS NOT NULL AND b IS NOT NULL GROUP BY 1),
c AS (SELECT segment, my, ma, mb, (ay * bb - by_ * ab) / (aa * bb - ab * ab) AS b1, (by_ * aa - ay * ab) / (aa * bb - ab * ab) AS b2 FROM s),
o AS (SELECT segment, max(month) AS fin, list(value ORDER BY i) FILTER (i > n - 12) AS levels, max(y) FILTER (i = n) AS p, max(y) FILTER (i = n - 1) AS q FROM d GROUP BY 1),
f AS (SELECT segment, 0 AS step, fin, levels, p, q FROM o
  UNION ALL
  SELECT segment, step + 1, fin, list_append(levels[2:12], levels[1] + my + b1 * (p - ma) + b2 * (q - mb)), my + b1 * (p - ma) + b2 * (q - mb), p
  FROM f JOIN c USING (segment) WHERE step < 15)
SELECT segment, step::INT AS step, strftime(fin + to_months(step), '%Y-%m-%d') AS month, round(levels[12], 3) AS forecast FROM f WHERE step > 0"""


@query(_AR)
def ts_forecast_ar(spark, sf):
    out = T.forecast(by_segment(spark, sf), ["segment"], "month", "value", horizon=15, method="ar")
    return out.select("segment", "step", iso("month"), F.round("forecast", 3).alias("forecast"))


@query(f"""
WITH p AS (SELECT segment, value, lag(value, 12) OVER (PARTITION BY segment ORDER BY month) AS guess FROM {SEGMENTS})
SELECT segment, round(avg(abs(value - guess) / abs(value)), 9) AS mape FROM p GROUP BY segment""")
def ts_mape(spark, sf):
    from pyspark.sql import Window

    guess = F.lag("value", 12).over(Window.partitionBy("segment").orderBy("month"))
    return T.mape(by_segment(spark, sf).withColumn("guess", guess), "value", "guess", ["segment"]).withColumn("mape", F.round("mape", 9))


@query("""
WITH d AS (SELECT o_orderdate::DATE AS day, count(DISTINCT o_orderkey) AS orders, count(*) AS lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE o_orderdate::DATE >= DATE '1997-03-03' AND o_orderdate::DATE < DATE '1997-03-10' GROUP BY 1)
SELECT round(avg(lines / orders), 9) AS mean_lines_per_order, round(max(lines / orders), 9) AS max_lines_per_order,
  (SELECT strftime(day, '%A') FROM d ORDER BY lines DESC, day LIMIT 1) AS busiest_day, max(lines) AS max_lines,
  sum(lines)::BIGINT AS total_lines, sum(orders)::BIGINT AS total_orders FROM d""")
def weekly_kpis(spark, sf):
    lines = read(spark, sf, "lineitem").join(read(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    out = T.weekly_kpis(lines, "o_orderdate", "o_orderkey", week_start="1997-03-03")
    return out.withColumn("mean_lines_per_order", F.round("mean_lines_per_order", 9)).withColumn(
        "max_lines_per_order", F.round("max_lines_per_order", 9))
