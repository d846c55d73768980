"""Aggregation."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallgrass.functions.conditions import n_rows
from tallgrass.operators import aggregates as A
from tallgrass.operators.columns import numeric_columns
from tallgrass.queries import query, read

def money(col):
    """Amount as a decimal, so that its sums don't depend on the order of the rows."""
    return F.col(col).cast("decimal(18,2)")


def dbl(col):
    return col.cast("double")


@query("""
SELECT sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total, min(o_totalprice) AS low, max(o_totalprice) AS high,
       round(sum(o_totalprice::DECIMAL(18,2))::DOUBLE / count(o_totalprice), 4) AS mean FROM orders""")
def agg_global(spark, sf):
    return read(spark, sf, "orders").agg(
        dbl(F.sum(money("o_totalprice"))).alias("total"), F.min("o_totalprice").alias("low"),
        F.max("o_totalprice").alias("high"), F.round(dbl(F.sum(money("o_totalprice"))) / F.count("o_totalprice"), 4).alias("mean"))


@query("""
WITH m AS (SELECT avg(l_quantity) AS mu FROM lineitem),
c AS (SELECT avg((l_quantity - mu) ** 2) m2, avg((l_quantity - mu) ** 3) m3, avg((l_quantity - mu) ** 4) m4 FROM lineitem, m)
SELECT count(l_quantity) AS n, count(DISTINCT l_quantity) AS n_distinct, sum(DISTINCT l_quantity) AS sum_distinct,
  min(l_quantity) AS min, max(l_quantity) AS max, sum(l_quantity) AS sum, round(avg(l_quantity), 6) AS mean,
  round(var_samp(l_quantity), 6) AS var_samp, round(var_pop(l_quantity), 6) AS var_pop,
  round(stddev_samp(l_quantity), 6) AS stddev_samp, round(stddev_pop(l_quantity), 6) AS stddev_pop,
  round(max(m4 / (m2 * m2) - 3), 6) AS kurtosis, round(max(m3 / m2 ** 1.5), 6) AS skewness,
  (SELECT l_quantity FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice LIMIT 1) AS first,
  (SELECT l_quantity FROM lineitem ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC LIMIT 1) AS last
FROM lineitem, c""")
def agg_full_profile(spark, sf):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    out = A.profile(read(spark, sf, "lineitem"), "l_quantity", order)
    exact = ("n", "n_distinct", "sum_distinct", "min", "max", "sum", "first", "last")
    return out.select(*[c if c in exact else F.round(c, 6).alias(c) for c in out.columns])


@query()
def agg_approx_distinct(spark, sf):
    return read(spark, sf, "lineitem").agg(
        F.approx_count_distinct("l_partkey", rsd=0.1).alias("approx_parts"),
        F.count_distinct("l_partkey").alias("parts"))


@query("""
SELECT round(corr(l_quantity, l_extendedprice), 6) AS corr, round(covar_pop(l_quantity, l_extendedprice), 2) AS covar_pop,
       round(covar_samp(l_quantity, l_extendedprice), 2) AS covar_samp FROM lineitem""")
def agg_corr_cov(spark, sf):
    a, b = "l_quantity", "l_extendedprice"
    return read(spark, sf, "lineitem").agg(
        F.round(F.corr(a, b), 6).alias("corr"), F.round(F.covar_pop(a, b), 2).alias("covar_pop"),
        F.round(F.covar_samp(a, b), 2).alias("covar_samp"))


_PRICING = """
SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS sum_price,
       sum(l_extendedprice::DECIMAL(18,2) * (1 - l_discount::DECIMAL(18,2)))::DOUBLE AS revenue,
       round(avg(l_quantity), 6) AS avg_qty, count(*) AS n
FROM lineitem GROUP BY l_returnflag, l_linestatus"""


@query(_PRICING)
def agg_group(spark, sf):
    revenue = money("l_extendedprice") * (1 - money("l_discount"))
    return read(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), dbl(F.sum(money("l_extendedprice"))).alias("sum_price"),
        dbl(F.sum(revenue)).alias("revenue"),
        F.round(F.avg("l_quantity"), 6).alias("avg_qty"), n_rows().alias("n"))


@query(_PRICING)
def agg_group_sql(spark, sf):
    view = f"lineitem_{uuid.uuid4().hex}"
    read(spark, sf, "lineitem").createOrReplaceTempView(view)
    return spark.sql(f"""
        SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))) AS DOUBLE) AS revenue,
               round(avg(l_quantity), 6) AS avg_qty, count(*) AS n
        FROM {view} GROUP BY l_returnflag, l_linestatus""")


@query("""SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers, count(*) AS n FROM orders GROUP BY o_orderpriority""")
def agg_count_distinct_group(spark, sf):
    return read(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.count_distinct("o_custkey").alias("customers"), n_rows().alias("n"))


@query("""
SELECT l_suppkey, sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice::DECIMAL(18,2) ELSE 0 END)::DOUBLE AS returned,
       count(*) FILTER (l_discount > 0.05) AS discounted FROM lineitem GROUP BY l_suppkey""")
def agg_conditional(spark, sf):
    returned = F.when(F.col("l_returnflag") == "R", money("l_extendedprice")).otherwise(0)
    return read(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        dbl(F.sum(returned)).alias("returned"), F.count_if(F.col("l_discount") > 0.05).alias("discounted"))


@query("""
SELECT source, arg_min(quality, doc_id) FILTER (quality IS NOT NULL) AS first_quality
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source""")
def agg_first_nonnull(spark, sf):
    joined = read(spark, sf, "documents").select("doc_id", "source").join(read(spark, sf, "labels"), "doc_id", "left")
    known = F.when(F.col("quality").isNotNull(), F.col("doc_id"))
    return joined.groupBy("source").agg(F.min_by("quality", known).alias("first_quality"))


@query("""
SELECT lang, source, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY lang), 6) AS percent
FROM documents GROUP BY lang, source""")
def agg_percent_of_group(spark, sf):
    return A.percent_of_group(read(spark, sf, "documents"), ["lang"], "source").withColumn("percent", F.round("percent", 6))


@query("""
SELECT event_type, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std,
       round(stddev_pop(value) / sqrt(count(value)), 6) AS stderr FROM events GROUP BY event_type""")
def agg_stderr(spark, sf):
    out = A.standard_error(read(spark, sf, "events"), ["event_type"], "value")
    return out.select("event_type", *[F.round(c, 6).alias(c) for c in ("mean", "std", "stderr")])


@query("""
SELECT l_returnflag, l_linestatus, sum(l_quantity) AS qty, grouping(l_returnflag, l_linestatus)::BIGINT AS level
FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def rollup(spark, sf):
    return A.subtotals(read(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], [F.sum("l_quantity").alias("qty")])


@query("""
SELECT l_returnflag, l_linestatus, sum(l_quantity) AS qty, count(*) AS n, grouping(l_returnflag, l_linestatus)::BIGINT AS level
FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""")
def cube(spark, sf):
    return A.subtotals(read(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"],
                       [F.sum("l_quantity").alias("qty"), n_rows().alias("n")], kind="cube")


@query("""
SELECT * FROM (SELECT o_orderstatus, o_orderpriority, count(*) AS n, grouping(o_orderstatus, o_orderpriority)::BIGINT AS level
FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)) WHERE level IN (1, 2, 3)""")
def grouping_level(spark, sf):
    return A.subtotals(read(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"], [n_rows().alias("n")],
                       kind="cube", levels=[1, 2, 3])


@query("""
SELECT l_returnflag, sum(l_extendedprice::DECIMAL(18,2)) FILTER (l_linestatus = 'O')::DOUBLE AS "O",
       sum(l_extendedprice::DECIMAL(18,2)) FILTER (l_linestatus = 'F')::DOUBLE AS "F" FROM lineitem GROUP BY l_returnflag""")
def pivot_sum(spark, sf):
    lines = read(spark, sf, "lineitem").withColumn("l_extendedprice", money("l_extendedprice"))
    out = A.pivot_sum(lines, ["l_returnflag"], "l_linestatus", "l_extendedprice", values=["O", "F"])
    return out.select("l_returnflag", *[dbl(F.col(c)).alias(c) for c in ("O", "F")])


@query("""
SELECT coalesce(o_orderpriority, 'Total') AS o_orderpriority, sum(o_totalprice::DECIMAL(18,2)) FILTER (o_orderstatus = 'F')::DOUBLE AS "F",
       sum(o_totalprice::DECIMAL(18,2)) FILTER (o_orderstatus = 'O')::DOUBLE AS "O", sum(o_totalprice::DECIMAL(18,2)) FILTER (o_orderstatus = 'P')::DOUBLE AS "P"
FROM orders GROUP BY ROLLUP (o_orderpriority)""")
def pivot_total_row(spark, sf):
    orders = read(spark, sf, "orders").withColumn("o_totalprice", money("o_totalprice"))
    out = A.pivot_sum(orders, ["o_orderpriority"], "o_orderstatus", "o_totalprice",
                      values=["F", "O", "P"], total=True)
    return out.select("o_orderpriority", *[dbl(F.col(c)).alias(c) for c in ("F", "O", "P")])


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("SELECT o_orderstatus, " + ", ".join(
    f"count(*) FILTER (o_orderpriority = '{p}') AS \"{p}\"" for p in _PRIORITIES) + " FROM orders GROUP BY o_orderstatus")
def crosstab(spark, sf):
    return A.crosstab(read(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")


@query("SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 10")
def value_counts(spark, sf):
    return A.value_counts(read(spark, sf, "part"), "p_brand", top=10)


@query("SELECT DISTINCT c_mktsegment FROM customer")
def distinct_values(spark, sf):
    return read(spark, sf, "customer").select("c_mktsegment").distinct()


@query("""
SELECT 'l_orderkey' AS keys, count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_distinct,
       round(count(*) / count(DISTINCT l_orderkey), 9) AS cardinality, round(count(DISTINCT l_orderkey) / count(*), 9) AS entropy,
       count(*) = count(DISTINCT l_orderkey) AS is_key FROM lineitem
UNION ALL
SELECT 'l_orderkey,l_partkey,l_suppkey', count(*), count(DISTINCT (l_orderkey, l_partkey, l_suppkey)),
       round(count(*) / count(DISTINCT (l_orderkey, l_partkey, l_suppkey)), 9),
       round(count(DISTINCT (l_orderkey, l_partkey, l_suppkey)) / count(*), 9),
       count(*) = count(DISTINCT (l_orderkey, l_partkey, l_suppkey)) FROM lineitem""")
def key_profile(spark, sf):
    lineitem = read(spark, sf, "lineitem")
    both = A.key_profile(lineitem, ["l_orderkey"]).unionByName(
        A.key_profile(lineitem, ["l_orderkey", "l_partkey", "l_suppkey"]))
    return both.withColumn("cardinality", F.round("cardinality", 9)).withColumn("entropy", F.round("entropy", 9))


@query("""
SELECT p_partkey, 'p_size' AS measure, p_size::DOUBLE AS value FROM part
UNION ALL SELECT p_partkey, 'p_retailprice', p_retailprice FROM part""")
def unpivot(spark, sf):
    part = read(spark, sf, "part").withColumn("p_size", F.col("p_size").cast("double"))
    return A.unpivot_measures(part, ["p_partkey"], ["p_size", "p_retailprice"])


@query("""
SELECT o_orderstatus, min(o_orderkey) AS o_orderkey, o_totalprice FROM orders
JOIN (SELECT o_orderstatus, max(o_totalprice) AS o_totalprice FROM orders GROUP BY 1) USING (o_orderstatus, o_totalprice)
GROUP BY o_orderstatus, o_totalprice""")
def max_row_label(spark, sf):
    return A.label_of_max(read(spark, sf, "orders"), ["o_orderstatus"], "o_orderkey", "o_totalprice")


@query("""
SELECT user_id, sum(CASE WHEN event_type IN ('purchase', 'signup') THEN value::DECIMAL(18,2) WHEN event_type = 'error' THEN -value::DECIMAL(18,2) END)::DOUBLE AS balance
FROM events GROUP BY user_id""")
def signed_ledger(spark, sf):
    events = read(spark, sf, "events").withColumn("value", money("value"))
    return A.signed_ledger(events, ["user_id"], "event_type", "value",
                           plus=["purchase", "signup"], minus=["error"]).withColumn("balance", dbl(F.col("balance")))


_NUMS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(" UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM lineitem" for a in _NUMS for b in _NUMS))
def correlation_matrix(spark, sf):
    lineitem = read(spark, sf, "lineitem")
    return A.correlation_pairs(lineitem, numeric_columns(lineitem)).withColumn("corr", F.round("corr", 6))
