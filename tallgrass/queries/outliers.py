"""Outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.plans import outliers as X
from tallgrass.queries import query, read


@query("""
WITH q AS (SELECT quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM events)
SELECT event_id, user_id, value FROM events, q WHERE value < lo OR value > hi""")
def outlier_quantile(spark, sf):
    return X.quantile_outliers(read(spark, sf, "events").select("event_id", "user_id", "value"), "value")


@query("""
WITH q AS (SELECT o_orderpriority, quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS q2, quantile_cont(o_totalprice, 0.75) AS q3
FROM orders GROUP BY 1)
SELECT o_orderpriority, round(q1, 6) AS q1, round(q2, 6) AS q2, round(q3, 6) AS q3 FROM q""")
def exact_quartiles(spark, sf):
    from tallgrass.operators.ordered import exact_quantiles

    out = exact_quantiles(read(spark, sf, "orders"), ["o_orderpriority"], "o_totalprice", {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    return out.select("o_orderpriority", *[F.round(c, 6).alias(c) for c in ("q1", "q2", "q3")])


def order_habits(spark, sf):
    return read(spark, sf, "orders").groupBy(F.col("o_custkey").alias("id")).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        (F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))).alias("v"))


@query("""
WITH b AS (SELECT o_custkey AS id, count(*)::DOUBLE AS n, sum(o_totalprice::DECIMAL(18,2))::DOUBLE / count(*) AS v FROM orders GROUP BY 1),
z AS (SELECT id, (n - avg(n) OVER ()) / stddev_pop(n) OVER () AS x, (v - avg(v) OVER ()) / stddev_pop(v) OVER () AS y FROM b),
d AS (SELECT a.id AS p, c.id AS q, sqrt((a.x - c.x) ** 2 + (a.y - c.y) ** 2) AS d FROM z a JOIN z c ON a.id <> c.id),
r AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY d) AS rn FROM d),
kd AS (SELECT p, max(d) AS kdist FROM r WHERE rn <= 15 GROUP BY p),
nb AS (SELECT d.p, d.q, d.d FROM d JOIN kd USING (p) WHERE d.d <= kd.kdist),
l AS (SELECT nb.p, count(*) / sum(greatest(nb.d, kd.kdist)) AS lrd FROM nb JOIN kd ON kd.p = nb.q GROUP BY nb.p),
f AS (SELECT nb.p, avg(l.lrd) AS m FROM nb JOIN l ON l.p = nb.q GROUP BY nb.p)
SELECT f.p AS id, round(m / lrd, 6) AS lof, m / lrd >= 1.25 AS is_outlier FROM f JOIN l USING (p)""")
def outlier_lof(spark, sf):
    """Customers by number and mean value of their orders."""
    out = X.lof(order_habits(spark, sf), "id", ["n", "v"], k=15)
    return out.select("id", F.round("lof", 6).alias("lof"), "is_outlier")


@query()
def outlier_lof_indexed(spark, sf):
    """As ``outlier_lof``, with neighbours from the index of random projections."""
    return X.lof(order_habits(spark, sf), "id", ["n", "v"], k=15, exact=False)
