"""Cohorts, RFM, tenure and segments."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.plans import customers as C
from tallgrass.queries import query, read
from tallgrass.session import materialize


def iso(col):
    return F.date_format(col, "yyyy-MM-dd").alias(col)


def purchases(spark, sf):
    return read(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))


@query("""
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month,
  sum(l_quantity::INT * l_extendedprice::DECIMAL(18,2))::DOUBLE AS sales
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def monthly_sales(spark, sf):
    unit = F.col("l_extendedprice").cast("decimal(18,2)")
    lines = read(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_quantity").cast("int") * unit).alias("line"))
    joined = lines.join(read(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return C.monthly_sales(joined, "o_orderdate", "line").select(iso("month"), F.col("sales").cast("double").alias("sales"))


_COHORTS = """
SELECT customer, month, min(month) OVER (PARTITION BY customer) AS cohort,
  (12 * (year(month) - year(min(month) OVER (PARTITION BY customer))) + month(month) - month(min(month) OVER (PARTITION BY customer)) + 1)::INT AS "index"
FROM (SELECT DISTINCT o_custkey AS customer, date_trunc('month', o_orderdate)::DATE AS month FROM orders)"""


@query(f"""SELECT customer, strftime(month, '%Y-%m-%d') AS month, strftime(cohort, '%Y-%m-%d') AS cohort, "index" FROM ({_COHORTS})""")
def cohort_index(spark, sf):
    return C.cohort_months(purchases(spark, sf), "o_custkey", "o_orderdate").select("customer", iso("month"), iso("cohort"), "index")


@query(f"""
WITH c AS (SELECT strftime(cohort, '%Y-%m-%d') AS cohort, coalesce('m' || "index", 'undated') AS name, customer FROM ({_COHORTS}))
SELECT * FROM (
  PIVOT (FROM c UNION ALL SELECT DISTINCT cohort, 'm' || i, NULL FROM c, range(1, 81) r(i)) ON name USING count(DISTINCT customer) GROUP BY cohort)""")
def cohort_counts(spark, sf):
    """A row per cohort and a column per month index: m1 to m80, and whatever later ones (or undated orders) the data have."""
    out = C.cohort_matrix(purchases(spark, sf), "o_custkey", "o_orderdate", least=80)
    return out.select(iso("cohort"), *[F.coalesce(c, F.lit(0)).alias(c) for c in out.columns if c != "cohort"])


@query(f"""
WITH c AS (SELECT cohort, "index", count(DISTINCT customer) AS customers FROM ({_COHORTS}) GROUP BY ALL)
SELECT strftime(cohort, '%Y-%m-%d') AS cohort, "index", customers,
  round(customers * 100.0::DOUBLE / max(CASE WHEN "index" = 1 THEN customers END) OVER (PARTITION BY cohort), 2) AS retention FROM c""")
def cohort_retention(spark, sf):
    return C.cohort_retention(purchases(spark, sf), "o_custkey", "o_orderdate").select(iso("cohort"), "index", "customers", "retention")


_RFM = """
SELECT o_custkey AS customer, date_diff('day', max(o_orderdate)::DATE, (SELECT max(o_orderdate)::DATE + 1 FROM orders))::INT AS recency,
  count(*) AS frequency, sum(o_totalprice::DECIMAL(18,2)) AS monetary FROM orders GROUP BY o_custkey"""
_SCORES = f"""
WITH b AS ({_RFM}),
e AS (SELECT quantile_cont(recency::DOUBLE, [0.2, 0.4, 0.6, 0.8]) AS er, quantile_cont(frequency::DOUBLE, [0.2, 0.4, 0.6, 0.8]) AS ef,
  quantile_cont(monetary::DOUBLE, [0.2, 0.4, 0.6, 0.8]) AS em FROM b),
s AS (SELECT b.*, (5 - len(list_filter(er, lambda x: recency > x)))::INT AS r, (1 + len(list_filter(ef, lambda x: frequency > x)))::INT AS f,
  (1 + len(list_filter(em, lambda x: monetary::DOUBLE > x)))::INT AS m FROM b, e)"""


def base(spark, sf):
    return C.rfm_base(purchases(spark, sf), "o_custkey", "o_orderdate", "amount")


def money(df):
    return df.withColumn("monetary", F.col("monetary").cast("double"))


@query(f"SELECT customer, recency, frequency, monetary::DOUBLE AS monetary FROM ({_RFM})")
def rfm_base(spark, sf):
    return money(base(spark, sf))


@query(f"{_SCORES} SELECT customer, r, f, m, r + f + m AS score FROM s")
def rfm_scores(spark, sf):
    return C.rfm_scores(base(spark, sf)).select("customer", "r", "f", "m", "score")


@query(f"""{_SCORES}, l AS (SELECT *, CASE WHEN r + f + m >= 14 THEN 'Platinum Plus' WHEN r + f + m >= 11 THEN 'Platinum' WHEN r + f + m >= 8 THEN 'Gold'
  WHEN r + f + m >= 6 THEN 'Silver' ELSE 'Bronze' END AS level FROM s)
SELECT level, round(avg(recency), 1) AS recency, round(avg(frequency), 1) AS frequency, round(avg(monetary::DOUBLE), 1) AS monetary, count(*) AS customers
FROM l GROUP BY level""")
def rfm_levels(spark, sf):
    return C.rfm_levels(money(C.rfm_scores(base(spark, sf))))


@query(f"""
WITH b AS (SELECT customer, ln(recency) AS r, ln(frequency) AS f, ln(monetary::DOUBLE + abs(min(monetary) OVER ())::DOUBLE + 1) AS m FROM ({_RFM}))
SELECT customer, round((r - avg(r) OVER ()) / stddev_pop(r) OVER (), 6) AS recency, round((f - avg(f) OVER ()) / stddev_pop(f) OVER (), 6) AS frequency,
  round((m - avg(m) OVER ()) / stddev_pop(m) OVER (), 6) AS monetary FROM b""")
def rfm_normalize(spark, sf):
    out = C.log_zscore(money(base(spark, sf)), ["recency", "frequency", "monetary"], shift=["monetary"])
    return out.select("customer", *[F.round(c, 6).alias(c) for c in ("recency", "frequency", "monetary")])


@query("""
SELECT o_custkey AS customer, strftime(min(o_orderdate), '%Y-%m-%d') AS first_day,
  (date_diff('day', min(o_orderdate)::DATE, (SELECT max(o_orderdate)::DATE FROM orders)) + 1)::INT AS tenure FROM orders GROUP BY o_custkey""")
def customer_tenure(spark, sf):
    return C.customer_tenure(purchases(spark, sf), "o_custkey", "o_orderdate").select("customer", iso("first_day"), "tenure")


def scaled(spark, sf):
    return C.log_zscore(money(base(spark, sf)), ["recency", "frequency", "monetary"], shift=["monetary"])


@query()
def kmeans_segments(spark, sf):
    cols = ["recency", "frequency", "monetary"]
    return C.cluster_profile(C.kmeans_segments(materialize(scaled(spark, sf)), cols, 5, id_col="customer"), "cluster", cols)


@query()
def kmeans_elbow(spark, sf):
    return C.kmeans_elbow(scaled(spark, sf), ["recency", "frequency", "monetary"], range(2, 15), id_col="customer")


@query("""
SELECT c_mktsegment, round(avg(o_totalprice) / (SELECT avg(o_totalprice) FROM orders) - 1, 9) AS o_totalprice,
  round(avg(c_acctbal) / (SELECT avg(c_acctbal) FROM orders JOIN customer ON o_custkey = c_custkey) - 1, 9) AS c_acctbal
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def cluster_relative_importance(spark, sf):
    joined = read(spark, sf, "orders").join(read(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    out = C.relative_importance(joined, "c_mktsegment", ["o_totalprice", "c_acctbal"])
    return out.select("c_mktsegment", F.round("o_totalprice", 9).alias("o_totalprice"), F.round("c_acctbal", 9).alias("c_acctbal"))
