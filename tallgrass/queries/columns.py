"""Projection, columns, rows and metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.functions.numbers import int_or_null
from tallgrass.operators import columns as C
from tallgrass.queries import query, read


@query("SELECT o_orderkey, o_totalprice, o_totalprice * 2 AS doubled, upper(o_orderpriority) AS priority FROM orders")
def project(spark, sf):
    return read(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_totalprice", "o_totalprice * 2 AS doubled", "upper(o_orderpriority) AS priority")


@query("SELECT 'TPC' AS origin, n_nationkey, 1 AS one, n_name, n_regionkey FROM nation")
def literal_col(spark, sf):
    df = C.add_constant(read(spark, sf, "nation"), "origin", "TPC", position=0)
    return C.add_constant(df, "one", 1, position=2)


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round(l_extendedprice / l_quantity, 9) AS "unit price" FROM lineitem""")
def calc_col(spark, sf):
    df = read(spark, sf, "lineitem").withColumn("unit price", F.col("l_extendedprice") / F.col("l_quantity"))
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     F.expr("round(`unit price`, 9)").alias("unit price"))


@query("SELECT c_custkey AS customer_id, c_name AS name, c_nationkey, c_acctbal, c_mktsegment AS channel FROM customer")
def rename_col(spark, sf):
    return read(spark, sf, "customer").withColumnsRenamed(
        {"c_custkey": "customer_id", "c_name": "name", "c_mktsegment": "channel"})


@query("SELECT p_partkey, p_name, p_type, p_retailprice FROM part")
def drop_col(spark, sf):
    return read(spark, sf, "part").drop("p_brand", "p_size")


@query("""
SELECT o_orderkey::VARCHAR AS key_text, floor(o_totalprice)::BIGINT AS whole,
       TRY_CAST(o_orderpriority AS INT) AS bad_number, TRY_CAST(left(o_orderpriority, 1) AS INT) AS level,
       strftime(o_orderdate::DATE, '%Y-%m-%d') AS day FROM orders""")
def cast_col(spark, sf):
    return read(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("key_text"), F.floor("o_totalprice").cast("bigint").alias("whole"),
        int_or_null(F.col("o_orderpriority")).alias("bad_number"),
        int_or_null(F.col("o_orderpriority").substr(1, 1)).alias("level"),
        F.col("o_orderdate").cast("date").cast("string").alias("day"))


@query("""SELECT n_nationkey AS nation_key, n_name AS nation_name, n_regionkey AS nation_name_1 FROM nation""")
def sanitize_columns(spark, sf):
    return C.sanitize_columns(read(spark, sf, "nation").toDF("nation key", "nation,name", "nation name"))


@query("SELECT r_regionkey AS Sales_dollars, r_name AS On_Flyer FROM region")
def rename_all(spark, sf):
    return C.rename_symbols(read(spark, sf, "region").toDF("Sales $", "On Flyer? "),
                            {" ": "_", "?": "", "$": "dollars", "#": "num"})


@query("SELECT c_custkey AS id, c_name AS NAME FROM customer WHERE c_acctbal > 0")
def case_insensitive_names(spark, sf):
    return read(spark, sf, "customer").where(F.col("C_ACCTBAL") > 0).select(
        F.col("C_CustKey").alias("id"), F.col("C_NAME").alias("NAME"))


@query("""
SELECT 'l_quantity' AS "column", count(l_quantity) AS count, round(avg(l_quantity), 6) AS mean,
       round(stddev_samp(l_quantity), 6) AS stddev, min(l_quantity) AS min, max(l_quantity) AS max FROM lineitem
UNION ALL SELECT 'l_discount', count(l_discount), round(avg(l_discount), 6), round(stddev_samp(l_discount), 6),
       min(l_discount), max(l_discount) FROM lineitem""")
def describe_stats(spark, sf):
    return C.describe(read(spark, sf, "lineitem"), ["l_quantity", "l_discount"]).select(
        "column", "count", F.round("mean", 6).alias("mean"), F.round("stddev", 6).alias("stddev"), "min", "max")


@query(" UNION ALL ".join(f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev,
  min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, round(quantile_cont({c}::DOUBLE, 0.25), 6) AS q25, round(quantile_cont({c}::DOUBLE, 0.5), 6) AS q50,
  round(quantile_cont({c}::DOUBLE, 0.75), 6) AS q75 FROM part""" for c in ("p_size", "p_retailprice")))
def summary_stats(spark, sf):
    out = C.summary(read(spark, sf, "part"), ["p_size", "p_retailprice"])
    exact = ("column", "count", "min", "max")
    return out.select(*[c if c in exact else F.round(c, 6).alias(c) for c in out.columns])


@query("""
SELECT 0 AS ordinal, 'c_custkey' AS "column", 'bigint' AS type, (SELECT count(*) FROM customer) AS n_rows
UNION ALL SELECT 1, 'c_name', 'string', (SELECT count(*) FROM customer)
UNION ALL SELECT 2, 'c_nationkey', 'int', (SELECT count(*) FROM customer)
UNION ALL SELECT 3, 'c_acctbal', 'double', (SELECT count(*) FROM customer)
UNION ALL SELECT 4, 'c_mktsegment', 'string', (SELECT count(*) FROM customer)""")
def schema_meta(spark, sf):
    customer = read(spark, sf, "customer")
    return C.schema_rows(customer).withColumn("n_rows", customer.agg(F.count(F.lit(1))).scalar())


@query("SELECT p_partkey, p_size, p_retailprice FROM part")
def numeric_columns(spark, sf):
    part = read(spark, sf, "part")
    return part.select(*C.numeric_columns(part))


@query("""SELECT '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}' AS json
FROM nation""")
def to_json_rows(spark, sf):
    return C.to_json_rows(read(spark, sf, "nation"))


@query("SELECT r_regionkey, r_name, (SELECT count(*) FROM nation WHERE n_regionkey = r_regionkey) AS nations FROM region")
def collect_small(spark, sf):
    """Rows pulled to the driver behind a limit and put back as literal rows."""
    per_region = read(spark, sf, "nation").groupBy("n_regionkey").count()
    rows = C.take_checked(read(spark, sf, "region").join(per_region, F.col("r_regionkey") == F.col("n_regionkey"))
                          .select("r_regionkey", "r_name", "count"), limit=100)
    return spark.createDataFrame([tuple(r) for r in rows], "r_regionkey int, r_name string, nations bigint")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_n_head(spark, sf):
    return C.top_rows(read(spark, sf, "orders").select("o_orderkey", "o_totalprice"),
                      [F.desc("o_totalprice"), "o_orderkey"], 10)
