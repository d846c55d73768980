"""Joins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallgrass.functions.conditions import recode
from tallgrass.operators import joins as J
from tallgrass.queries import query, read


def _docs(spark, sf):
    return read(spark, sf, "documents").select("doc_id", "lang", "source")


@query("""SELECT o_orderkey, o_totalprice, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""")
def join_inner(spark, sf):
    orders, customer = read(spark, sf, "orders"), read(spark, sf, "customer")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        "o_orderkey", "o_totalprice", "c_name", "c_mktsegment")


@query("SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)")
def join_left(spark, sf):
    return _docs(spark, sf).join(read(spark, sf, "labels"), "doc_id", "left").select("doc_id", "lang", "quality", "toxic")


@query("SELECT doc_id, lang, quality, toxic FROM labels RIGHT JOIN documents USING (doc_id)")
def join_right(spark, sf):
    return read(spark, sf, "labels").join(_docs(spark, sf), "doc_id", "right").select("doc_id", "lang", "quality", "toxic")


@query("""
WITH a AS (SELECT c_nationkey AS k, count(*) AS customers FROM customer WHERE c_acctbal > 9700 GROUP BY 1),
     b AS (SELECT s_nationkey AS k, count(*) AS suppliers FROM supplier WHERE s_acctbal > 6000 GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, customers, suppliers,
       CASE WHEN a.k IS NULL THEN 'right' WHEN b.k IS NULL THEN 'left' ELSE 'both' END AS side
FROM a FULL JOIN b ON a.k = b.k""")
def join_full(spark, sf):
    a = read(spark, sf, "customer").where("c_acctbal > 9700").groupBy(F.col("c_nationkey").alias("k")).agg(
        F.count(F.lit(1)).alias("customers"))
    b = read(spark, sf, "supplier").where("s_acctbal > 6000").groupBy(F.col("s_nationkey").alias("k")).agg(
        F.count(F.lit(1)).alias("suppliers"))
    side = F.when(F.col("customers").isNull(), "right").when(F.col("suppliers").isNull(), "left").otherwise("both")
    return a.join(b, "k", "full").withColumn("side", side)


@query("SELECT p_partkey, p_name FROM part WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 49)")
def join_semi(spark, sf):
    big = read(spark, sf, "lineitem").where("l_quantity > 49")
    return read(spark, sf, "part").join(big, F.col("p_partkey") == F.col("l_partkey"), "left_semi").select("p_partkey", "p_name")


@query("SELECT doc_id, lang, source FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = documents.doc_id)")
def join_anti(spark, sf):
    return _docs(spark, sf).join(read(spark, sf, "labels"), "doc_id", "left_anti")


@query("SELECT n_name, r_name FROM nation CROSS JOIN region")
def join_cross(spark, sf):
    """A product is only built with a side whose size is checked."""
    return J.product_with_small(read(spark, sf, "nation").select("n_name"), read(spark, sf, "region").select("r_name"))


@query("""SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_shipdate > (SELECT max(o_orderdate) FROM orders)""")
def join_scalar(spark, sf):
    last = read(spark, sf, "orders").agg(F.max("o_orderdate"))
    default = F.lit("1900-01-01").cast("timestamp_ntz")
    return J.after_scalar(read(spark, sf, "lineitem"), "l_shipdate", last, default).select(
        "l_orderkey", "l_linenumber", "l_extendedprice")


@query("""SELECT n_name, count(*) AS n_customers, sum(c_acctbal::DECIMAL(18,2))::DOUBLE AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def join_sql(spark, sf):
    tag = uuid.uuid4().hex
    read(spark, sf, "customer").createOrReplaceTempView(f"customer_{tag}")
    read(spark, sf, "nation").createOrReplaceTempView(f"nation_{tag}")
    return spark.sql(f"""
        SELECT n_name, count(*) AS n_customers, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
        FROM customer_{tag} JOIN nation_{tag} ON c_nationkey = n_nationkey GROUP BY n_name""")


@query("SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def join_broadcast(spark, sf):
    nation = read(spark, sf, "nation")
    customer = read(spark, sf, "customer")
    return J.join_broadcast(customer, nation, customer.c_nationkey == nation.n_nationkey).select("c_custkey", "n_name")


@query("""
SELECT u.user_id, v.n AS n_view, c.n AS n_click, p.n AS n_purchase
FROM (SELECT DISTINCT user_id FROM events) u
LEFT JOIN (SELECT user_id, count(*) n FROM events WHERE event_type = 'view' GROUP BY 1) v USING (user_id)
LEFT JOIN (SELECT user_id, count(*) n FROM events WHERE event_type = 'click' GROUP BY 1) c USING (user_id)
LEFT JOIN (SELECT user_id, count(*) n FROM events WHERE event_type = 'purchase' AND value > 150 GROUP BY 1) p USING (user_id)""")
def join_multiway_suffix(spark, sf):
    events = read(spark, sf, "events")

    def stage(cond):
        return events.where(cond).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))

    return J.join_on_key(
        [events.select("user_id").distinct(), stage("event_type = 'view'"), stage("event_type = 'click'"),
         stage("event_type = 'purchase' AND value > 150")],
        "user_id", suffixes=["", "_view", "_click", "_purchase"])


@query("""
SELECT n_name, p_type, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS sales FROM lineitem
JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey GROUP BY n_name, p_type""")
def join_star(spark, sf):
    sales = J.join_star(read(spark, sf, "lineitem"), [
        (read(spark, sf, "part"), "l_partkey", "p_partkey", "inner"),
        (read(spark, sf, "orders"), "l_orderkey", "o_orderkey", "inner"),
        (read(spark, sf, "customer"), "o_custkey", "c_custkey", "inner"),
        (read(spark, sf, "nation"), "c_nationkey", "n_nationkey", "inner"),
    ])
    return sales.groupBy("n_name", "p_type").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("sales"))


@query("""
SELECT c_custkey, n_name, r_name, o_orderkey FROM customer JOIN orders ON o_custkey = c_custkey
JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey WHERE o_orderstatus = 'P'""")
def join_chain(spark, sf):
    orders = read(spark, sf, "orders").where("o_orderstatus = 'P'")
    return (read(spark, sf, "customer").join(orders, F.col("o_custkey") == F.col("c_custkey"))
            .join(read(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
            .join(read(spark, sf, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
            .select("c_custkey", "n_name", "r_name", "o_orderkey"))


@query("""SELECT event_id, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 END AS stage FROM events""")
def lookup_map_recode(spark, sf):
    return read(spark, sf, "events").select(
        "event_id", recode(F.col("event_type"), {"view": 1, "click": 2, "purchase": 3}).alias("stage"))
