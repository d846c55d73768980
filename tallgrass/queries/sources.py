"""Sources and sinks: each table goes through the format and back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallgrass.queries import query, read
from tallgrass.session import dealt, lookup, scratch_path
from tallgrass.sources import files, generated, tables

ORDERS_SCHEMA = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                 "o_orderdate timestamp_ntz, o_orderpriority string")

_ORDERS = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
FROM orders
"""


def _dated(df):
    return df.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


def _csv_orders(spark, sf):
    path = scratch_path(spark, "orders-csv")
    files.write_csv(read(spark, sf, "orders"), path, compression="gzip")
    return path


@query(_ORDERS)
def scan_csv_infer(spark, sf):
    return _dated(files.read_csv(spark, _csv_orders(spark, sf) + "/*.csv.gz"))


@query(_ORDERS)
def scan_csv_schema(spark, sf):
    return _dated(files.read_csv(spark, _csv_orders(spark, sf), schema=ORDERS_SCHEMA))


@query(_ORDERS)
def scan_json(spark, sf):
    path = scratch_path(spark, "orders-json")
    files.write_files(read(spark, sf, "orders"), path, fmt="json")
    return _dated(files.read_json(spark, path, schema=ORDERS_SCHEMA))


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part WHERE p_size > 25")
def scan_parquet(spark, sf):
    return files.read_parquet(spark, f"{sf}/part.parquet").where(F.col("p_size") > 25)


@query("""
SELECT 'orc' AS kind, count(*) AS n_rows, sum(p_size)::BIGINT AS sizes FROM part
UNION ALL SELECT 'text', count(*), sum(length(p_name))::BIGINT FROM part""")
def scan_orc_text(spark, sf):
    part = read(spark, sf, "part")
    orc, text = scratch_path(spark, "part-orc"), scratch_path(spark, "part-text")
    files.write_files(part, orc, fmt="orc")
    files.write_files(part.select("p_name"), text, fmt="text")
    a = files.read_orc(spark, orc).agg(F.lit("orc").alias("kind"), F.count(F.lit(1)).alias("n_rows"),
                                       F.sum("p_size").alias("sizes"))
    b = files.read_text(spark, text).agg(F.lit("text").alias("kind"), F.count(F.lit(1)).alias("n_rows"),
                                         F.sum(F.length("value")).alias("sizes"))
    return a.unionByName(b)


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_regionkey = 1")
def scan_table(spark, sf):
    name = f"nation_{uuid.uuid4().hex}"
    tables.write_table(read(spark, sf, "nation"), name, path=scratch_path(spark, name))
    return tables.read_table(spark, name).where("n_regionkey = 1")


@query("SELECT i AS number FROM (SELECT unnest(range(0, (SELECT count(*) FROM part))) AS i)")
def range_source(spark, sf):
    return generated.number_range(spark, read(spark, sf, "part").count())


@query("""
SELECT r.r_name, c.code FROM region r
JOIN (VALUES (0, 'AF'), (1, 'AM'), (2, 'AS'), (3, 'EU'), (4, 'ME')) c(k, code) ON r.r_regionkey = c.k""")
def inline_rows(spark, sf):
    codes = generated.inline_rows(
        spark, [(0, "AF"), (1, "AM"), (2, "AS"), (3, "EU"), (4, "ME")], "r_regionkey int, code string")
    return read(spark, sf, "region").join(codes, "r_regionkey").select("r_name", "code")


@query("""
WITH e AS (SELECT min(o_orderdate)::DATE AS lo, max(o_orderdate)::DATE AS hi FROM orders),
d AS (SELECT unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM e)
SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, strftime(d, '%Y-%m-%d') AS date,
       year(d)::INT AS year, month(d)::INT AS month, day(d)::INT AS day,
       weekofyear(d)::INT AS week_of_year, strftime(d, '%a') AS day_name
FROM d""")
def calendar_source(spark, sf):
    days = generated.calendar_of(read(spark, sf, "orders"), "o_orderdate")
    return days.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query("""
SELECT (c_custkey % 20)::INT AS bucket, p_brand, count(*) AS items, count(DISTINCT o_orderkey) AS orders, count(DISTINCT c_custkey) AS customers, true AS in_range
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey GROUP BY ALL""")
def synthetic_sales_source(spark, sf):
    """Seeded sales for the keys of the given tables: who bought what, with values in the ranges they are drawn from."""
    key = {t: F.col(c).cast("long") for t, c in (("customer", "c_custkey"), ("part", "p_partkey"), ("orders", "o_orderkey"))}
    made = generated.sales_of(
        read(spark, sf, "customer").select(key["customer"].alias("id"), key["customer"].alias("customer_id")),
        read(spark, sf, "part").select(key["part"].alias("id"), key["part"].alias("product_id")),
        read(spark, sf, "orders").select(key["orders"].alias("id"), key["orders"].alias("order_id"), F.col("o_custkey").alias("customer_id")),
        read(spark, sf, "lineitem").select(F.xxhash64("l_orderkey", "l_linenumber").alias("id"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_item_id"),
                                           F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id")))
    brands = read(spark, sf, "part").select(F.col("p_partkey").alias("product_id"), "p_brand")
    fair = F.col("unit_price").between(10, 500) & F.col("quantity").between(1, 4)
    priced = made["products"].select("product_id", F.col("current_price").between(10, 500).alias("priced"))
    known = made["customers"].select("customer_id", (F.col("country").isNotNull() & F.col("marketing_channel").isNotNull()).alias("known"))
    sold = made["order_items"].select("order_id", "product_id", fair.alias("fair")).join(lookup(priced), "product_id").join(lookup(brands), "product_id")
    buyers = made["orders"].select("order_id", "customer_id", (F.year("order_ts") >= 2022).alias("timely")).join(lookup(known), "customer_id")
    n = read(spark, sf, "lineitem").count()
    per_order = dealt(sold, ["order_id"], n).join(buyers, "order_id").groupBy("customer_id", "order_id", "p_brand").agg(
        F.count(F.lit(1)).alias("items"), F.min(F.col("fair") & F.col("priced") & F.col("timely") & F.col("known")).alias("good"))
    per_customer = dealt(per_order, ["customer_id", "p_brand"], n).groupBy("customer_id", "p_brand").agg(
        F.sum("items").alias("items"), F.count(F.lit(1)).alias("orders"), F.min("good").alias("good"))
    return per_customer.groupBy((F.col("customer_id") % 20).cast("int").alias("bucket"), "p_brand").agg(
        F.sum("items").alias("items"), F.sum("orders").alias("orders"), F.count(F.lit(1)).alias("customers"), F.min("good").alias("in_range"))


@query(_ORDERS)
def sink_csv(spark, sf):
    path = scratch_path(spark, "orders-sep")
    files.write_csv(read(spark, sf, "orders"), path, sep=";", header=True, mode="overwrite")
    return _dated(files.read_csv(spark, path, schema=ORDERS_SCHEMA, sep=";"))


@query("""
SELECT o_orderpriority, count(*) AS n_orders, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total
FROM orders GROUP BY o_orderpriority""")
def sink_partitioned(spark, sf):
    path = scratch_path(spark, "orders-by-priority")
    files.write_files(read(spark, sf, "orders"), path, partition_by=["o_orderpriority"])
    return (files.read_parquet(spark, path).groupBy("o_orderpriority")
            .agg(F.count(F.lit(1)).alias("n_orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total")))


@query("""
SELECT save_mode, copies * n AS n_rows
FROM (VALUES ('append', 2), ('overwrite', 1), ('ignore', 1), ('error', 1)) m(save_mode, copies),
     (SELECT count(*) AS n FROM supplier)""")
def save_modes(spark, sf):
    """Rows present after writing the same table twice in each mode."""
    from pyspark.errors import AnalysisException

    supplier = read(spark, sf, "supplier")
    out = None
    for mode in files.SAVE_MODES:
        path = scratch_path(spark, f"mode-{mode}")
        files.write_files(supplier, path, mode=mode)
        try:
            files.write_files(supplier, path, mode=mode)
        except AnalysisException:
            if mode != "error":
                raise
        n = files.read_parquet(spark, path).agg(F.lit(mode).alias("save_mode"), F.count(F.lit(1)).alias("n_rows"))
        out = n if out is None else out.unionByName(n)
    return out


@query("""
SELECT c_mktsegment, count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""")
def sink_table(spark, sf):
    """Both sides bucketed by customer, so the join needs no shuffle."""
    tag = uuid.uuid4().hex
    o, c = f"orders_{tag}", f"customer_{tag}"
    tables.write_table(read(spark, sf, "orders"), o, bucket_by=(8, ["o_custkey"]), path=scratch_path(spark, o))
    tables.write_table(read(spark, sf, "customer"), c, bucket_by=(8, ["c_custkey"]), path=scratch_path(spark, c))
    joined = spark.table(o).join(spark.table(c).hint("merge"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_orders"),
                                              F.count_distinct("o_custkey").alias("n_customers"))


@query("""
SELECT s_suppkey::VARCHAR AS s_suppkey, s_name,
       CASE WHEN s_acctbal >= 5000 THEN s_nationkey::VARCHAR END AS s_nationkey FROM supplier""")
def copy_into_append(spark, sf):
    """Two inputs with different columns, loaded in turn and again; each lands once."""
    supplier = read(spark, sf, "supplier")
    first, second = scratch_path(spark, "in-a"), scratch_path(spark, "in-b")
    files.write_csv(supplier.where("s_acctbal < 5000").select("s_suppkey", "s_name"), first)
    files.write_csv(supplier.where("s_acctbal >= 5000").select("s_suppkey", "s_name", "s_nationkey"), second)
    target = scratch_path(spark, "stage")
    files.copy_into(spark, target, [first])
    files.copy_into(spark, target, [first, second])
    files.copy_into(spark, target, [first, second])
    return files.read_copied(spark, target).select("s_suppkey", "s_name", "s_nationkey")


@query("""
SELECT n_name AS name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def temp_views(spark, sf):
    tag = uuid.uuid4().hex
    tables.register_view(read(spark, sf, "customer"), f"c_{tag}")
    tables.register_view(read(spark, sf, "nation"), f"n_{tag}", everywhere=True)
    return spark.sql(f"""
        SELECT n_name AS name, count(*) AS n FROM c_{tag} JOIN global_temp.n_{tag} ON c_nationkey = n_nationkey
        GROUP BY n_name""")


@query("""
SELECT CASE WHEN s_acctbal < 3000 THEN '2024-01-01' ELSE '2024-02-01' END AS snapshot_date,
       count(*) AS n_rows, round(sum(s_acctbal), 2) AS balance
FROM supplier WHERE s_acctbal < 7000 GROUP BY 1""")
def snapshot_partition_scan(spark, sf):
    """Three dated folders, the last one without its second file and therefore left out."""
    supplier = read(spark, sf, "supplier")
    root = scratch_path(spark, "snapshots")
    bands = {"2024-01-01": "s_acctbal < 3000", "2024-02-01": "s_acctbal >= 3000 AND s_acctbal < 7000",
             "2024-03-01": "s_acctbal >= 7000"}
    for date, band in bands.items():
        files.write_csv(supplier.where(band), f"{root}/{date}/listings.csv")
        if date != "2024-03-01":
            files.write_csv(supplier.select("s_suppkey"), f"{root}/{date}/hosts.csv")
    dates = files.complete_snapshots(spark, root, ["listings.csv", "hosts.csv"])
    rows = files.read_snapshots(spark, root, "listings.csv", dates,
                                schema="s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double")
    return rows.groupBy(F.date_format("snapshot_date", "yyyy-MM-dd").alias("snapshot_date")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("s_acctbal"), 2).alias("balance"))


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def folder_ingest(spark, sf):
    """A folder of CSV files, a blank one among them, each read as its own table."""
    folder = scratch_path(spark, "inbox")
    files.write_csv(read(spark, sf, "supplier").repartition(4), folder)
    spark.range(1).selectExpr("'' AS value").coalesce(1).write.mode("append").text(f"{folder}/blank")
    frames, problems = files.ingest_folder(spark, folder)
    if problems:
        raise ValueError(f"unreadable files: {problems}")
    out = None
    for df in frames.values():
        rows = df.select(F.col("s_suppkey").cast("bigint"), "s_name", F.col("s_nationkey").cast("int"), F.col("s_acctbal").cast("double"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("""
SELECT 'nation_managed' AS name, 'MANAGED' AS kind, count(*) AS n_rows FROM nation
UNION ALL SELECT 'region_external', 'EXTERNAL', count(*) FROM region""")
def catalog_ops(spark, sf):
    """A schema with a managed, an external and a dropped table, listed from the catalog."""
    schema, before = f"staging_{uuid.uuid4().hex}", spark.catalog.currentDatabase()
    tables.create_schema(spark, schema, location=scratch_path(spark, "schema"), use=True)
    try:
        tables.write_table(read(spark, sf, "nation"), "nation_managed")
        tables.write_table(read(spark, sf, "region"), "region_external", path=scratch_path(spark, "external"))
        tables.write_table(read(spark, sf, "region"), "gone")
        tables.drop_table(spark, "gone")
        listed = [(t.name, t.tableType) for t in spark.catalog.listTables(schema) if not t.isTemporary]
    finally:
        spark.catalog.setCurrentDatabase(before)
    out = None
    for name, kind in listed:
        n = spark.table(f"{schema}.{name}").agg(F.lit(name).alias("name"), F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n_rows"))
        out = n if out is None else out.unionByName(n)
    return out
