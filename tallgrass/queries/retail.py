"""Promotion load and the sales warehouse."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.plans import incremental as I
from tallgrass.plans import promo as P
from tallgrass.plans import warehouse as W
from tallgrass.queries import query, read
from tallgrass.session import scratch_path
from tallgrass.sources.generated import calendar_of


def iso(col):
    return F.date_format(col, "yyyy-MM-dd").alias(col)


def dbl(col):
    return F.col(col).cast("double").alias(col)


# --- promotion rows from lineitem and part -------------------------------------------------


def promo_rows(spark, sf):
    d = F.col("l_shipdate")
    rows = read(spark, sf, "lineitem").join(read(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(
        F.concat(F.lit(" "), "p_name", F.lit(" ")).alias("Product"),
        F.extract(F.lit("YEAROFWEEK"), d).cast("int").alias("Year"), F.weekofyear(d).alias("week number"),
        F.col("p_retailprice").alias("Price"), F.col("l_discount").alias("Discount"),
        F.when(F.col("l_returnflag") == "R", "Yes").when(F.col("l_returnflag") == "N", "No").otherwise("?").alias("On Flyer?"),
        F.col("l_quantity").alias("Units"), F.col("l_extendedprice").alias("Sales $"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("Gross Margin $"),
        F.col("l_linenumber").alias("# Transactions that contained the product"))


def two_inputs(spark, sf):
    """Old and new promotions from one scan, named by the year."""
    return promo_rows(spark, sf).withColumn("input", F.when(F.col("Year") < 1998, "old").otherwise("new"))


_PROMO = """
WITH r AS (SELECT * REPLACE (p_retailprice::DECIMAL(18,2) AS p_retailprice, l_discount::DECIMAL(9,4) AS l_discount,
  l_extendedprice::DECIMAL(18,2) AS l_extendedprice), (l_extendedprice * l_tax)::DECIMAL(18,4) AS margin
  FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT isoyear(l_shipdate)::INT AS "Year", weekofyear(l_shipdate)::INT AS week_number, upper(p_name) AS "Product", p_retailprice::DOUBLE AS "Price",
  l_discount::DOUBLE AS "Discount", round(l_discount * 100, 2)::DOUBLE AS "Discount_Percent",
  round(p_retailprice * (1 - l_discount), 2)::DOUBLE AS "Final_Unit_Price",
  l_quantity AS "Units", l_extendedprice::DOUBLE AS "Sales_dollars", margin::DOUBLE AS "Gross_Margin_dollars", CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS "On_Flyer_Flag",
  CASE WHEN l_discount > 0.5 THEN 1 ELSE 0 END AS "High_Discount_Flag",
  CASE WHEN l_quantity >= 100 THEN 'High' WHEN l_quantity >= 50 THEN 'Medium' ELSE 'Low' END AS "Sales_Category",
  round(margin * 100 / l_extendedprice, 2)::DOUBLE AS "Gross_Margin_Percent", strftime(date_trunc('week', l_shipdate), '%Y-%m-%d') AS "Week_Start_Date"
FROM r"""


@query(_PROMO)
def promo_transform(spark, sf):
    """Every column of the operator, its decimals shown as doubles."""
    out = P.promo_transform(promo_rows(spark, sf))
    return out.select(*[dbl(c) if k.startswith("decimal") else iso(c) if k == "date" else c for c, k in out.dtypes])


@query("""
WITH r AS (SELECT isoyear(l_shipdate) < 1998 AS old, *, l_extendedprice * l_tax AS gm FROM lineitem JOIN part ON l_partkey = p_partkey),
g AS (SELECT CASE WHEN old THEN 'old' ELSE 'new' END AS input, count(*) FILTER (l_returnflag = 'A') AS flyer,
  count(*) FILTER (isoyear(l_shipdate) < 2000) AS years,
  count(*) FILTER (abs(l_extendedprice - l_quantity * p_retailprice * (1 - l_discount)) > 0.01) AS sales, count(*) AS n FROM r GROUP BY 1)
SELECT input, 'on_flyer' AS rule, flyer AS violations, n FROM g UNION ALL SELECT input, 'year_range', years, n FROM g
UNION ALL SELECT input, 'sales_consistency', sales, n FROM g""")
def promo_two_inputs(spark, sf):
    """Both inputs loaded as one; the broken rules of each, beside its row count."""
    return P.promo_report(two_inputs(spark, sf)).where("violations > 0").select("input", "rule", "violations", "n")


@query(f"""
WITH p AS ({_PROMO}), g AS (SELECT CASE WHEN "Year" < 1998 THEN 'old' ELSE 'new' END AS input, count(*) AS n_stored, count(*) AS n_rows,
  sum("Final_Unit_Price"::DECIMAL(18,2))::DOUBLE AS price, sum("Gross_Margin_dollars"::DECIMAL(18,4))::DOUBLE AS margin,
  count(*) FILTER ("Year" < 2000) AS years, sum("On_Flyer_Flag") AS flyers FROM p GROUP BY 1),
e AS (SELECT CASE WHEN isoyear(l_shipdate) < 1998 THEN 'old' ELSE 'new' END AS input, count(*) FILTER (l_returnflag = 'A') AS bad,
  count(*) FILTER (abs(l_extendedprice - l_quantity * p_retailprice * (1 - l_discount)) > 0.01) AS warnings
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
SELECT input, n_rows, n_stored, price, margin, flyers::BIGINT AS flyers, years + bad AS errors, warnings, 'written' AS status
FROM g JOIN e USING (input)""")
def promo_pipeline(spark, sf):
    """Outcome of the load, beside what the written files hold. The given tables break rules, so errors are allowed."""
    path = scratch_path(spark, "promo")
    outcome = P.promo_pipeline(two_inputs(spark, sf), path, allow_errors=True)
    stored = spark.read.parquet(path).groupBy("input").agg(
        F.count(F.lit(1)).alias("n_stored"), F.sum("Final_Unit_Price").cast("double").alias("price"),
        F.sum("Gross_Margin_dollars").cast("double").alias("margin"), F.sum("On_Flyer_Flag").alias("flyers"))
    return outcome.join(stored, "input")


# --- warehouse ----------------------------------------------------------------------------


def staging(spark, sf):
    """The given tables under the column names of the staging layer."""
    price, off = F.col("l_extendedprice").cast("decimal(18,2)"), F.col("l_discount").cast("decimal(18,2)")
    items = read(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), F.col("l_quantity").alias("quantity"),
        price.alias("unit_price"), (price * off).cast("decimal(18,2)").alias("discount_amount"))
    orders = read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("order_ts"),
        F.col("o_orderstatus").alias("order_status"), F.lit("USD").alias("currency"))
    products = read(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("current_price"), F.col("p_retailprice").alias("cost"))
    nation = read(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    customers = read(spark, sf, "customer").join(nation, "c_nationkey").select(
        F.col("c_custkey").alias("customer_id"), F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.concat(F.lower("c_mktsegment"), "c_custkey", F.lit("@example.com")).alias("email"), "country",
        F.col("c_mktsegment").alias("marketing_channel"), F.lit("1995-01-01 08:00:00").cast("timestamp_ntz").alias("created_ts"))
    return {"items": items, "orders": orders, "products": products, "customers": customers}


def fact(spark, sf):
    s = staging(spark, sf)
    return W.build_fact_order_items(s["items"], s["orders"], s["products"])


FACT = """
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS order_item_id, l_orderkey::VARCHAR AS order_id,
  o_custkey::VARCHAR AS customer_id, l_partkey::VARCHAR AS product_id, strftime(o_orderdate, '%Y%m%d')::INT AS order_date_key,
  o_orderdate::DATE AS order_date, o_orderstatus AS order_status, l_quantity::INT AS quantity,
  l_extendedprice::DECIMAL(18,2) AS unit_price, (l_extendedprice::DECIMAL(18,2) * l_discount::DECIMAL(18,2))::DECIMAL(18,2) AS discount_amount,
  l_quantity::INT * l_extendedprice::DECIMAL(18,2) AS extended_gross,
  l_quantity::INT * l_extendedprice::DECIMAL(18,2) - (l_extendedprice::DECIMAL(18,2) * l_discount::DECIMAL(18,2))::DECIMAL(18,2) AS extended_net,
  l_quantity::INT * p_retailprice::DECIMAL(18,2) AS cost_amount,
  l_quantity::INT * l_extendedprice::DECIMAL(18,2) - (l_extendedprice::DECIMAL(18,2) * l_discount::DECIMAL(18,2))::DECIMAL(18,2)
    - l_quantity::INT * p_retailprice::DECIMAL(18,2) AS margin_amount,
  p_type AS category, c_mktsegment AS marketing_channel
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN customer ON o_custkey = c_custkey"""


@query("""SELECT c_custkey::VARCHAR AS customer_id, n_name AS country, c_mktsegment AS marketing_channel, '1995-01-01' AS signup_date,
  split_part(c_name, '#', 2) AS last_name FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def dim_customer(spark, sf):
    return W.build_dim_customer(staging(spark, sf)["customers"]).select(
        "customer_id", "country", "marketing_channel", iso("signup_date"), "last_name")


@query("""SELECT p_partkey::VARCHAR AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
  p_retailprice::DECIMAL(18,2)::DOUBLE AS current_price, p_retailprice::DECIMAL(18,2)::DOUBLE AS cost FROM part""")
def dim_product(spark, sf):
    return W.build_dim_product(staging(spark, sf)["products"]).select(
        "product_id", "product_name", "category", "brand", dbl("current_price"), dbl("cost"))


@query("""
SELECT strftime(d, '%Y%m%d')::INT AS date_key, strftime(d, '%Y-%m-%d') AS date, year(d)::INT AS year, weekofyear(d)::INT AS week_of_year,
  strftime(d, '%a') AS day_name
FROM (SELECT unnest(generate_series(min(l_shipdate), max(l_shipdate), INTERVAL 1 DAY)) AS d FROM lineitem)""")
def dim_date(spark, sf):
    return calendar_of(read(spark, sf, "lineitem"), "l_shipdate").select("date_key", iso("date"), "year", "week_of_year", "day_name")


@query(f"""
SELECT order_item_id, order_id, customer_id, product_id, order_date_key, strftime(order_date, '%Y-%m-%d') AS order_date, order_status, quantity,
  unit_price::DOUBLE AS unit_price, discount_amount::DOUBLE AS discount_amount, extended_gross::DOUBLE AS extended_gross,
  extended_net::DOUBLE AS extended_net, cost_amount::DOUBLE AS cost_amount, margin_amount::DOUBLE AS margin_amount FROM ({FACT})""")
def fact_order_items(spark, sf):
    return fact(spark, sf).select("order_item_id", "order_id", "customer_id", "product_id", "order_date_key", iso("order_date"), "order_status", "quantity",
                                  *[dbl(c) for c in ("unit_price", "discount_amount", "extended_gross", "extended_net", "cost_amount", "margin_amount")])


@query(f"""
SELECT strftime(order_date, '%Y-%m-%d') AS date, sum(extended_net)::DOUBLE AS revenue, sum(margin_amount)::DOUBLE AS margin,
  count(DISTINCT order_id) AS orders FROM ({FACT}) GROUP BY 1""")
def mart_sales_daily(spark, sf):
    return W.mart_sales_daily(fact(spark, sf)).select(iso("date"), dbl("revenue"), dbl("margin"), "orders")


@query(f"""
SELECT marketing_channel, sum(extended_net)::DOUBLE AS revenue, sum(margin_amount)::DOUBLE AS margin,
  count(DISTINCT customer_id) AS customers FROM ({FACT}) GROUP BY 1""")
def mart_marketing_channel(spark, sf):
    customer = W.build_dim_customer(staging(spark, sf)["customers"])
    return W.mart_marketing_channel(fact(spark, sf), customer).select("marketing_channel", dbl("revenue"), dbl("margin"), "customers")


@query(f"""
SELECT category, sum(quantity)::BIGINT AS units, sum(extended_net)::DOUBLE AS revenue, sum(margin_amount)::DOUBLE AS margin
FROM ({FACT}) GROUP BY 1""")
def mart_product_category(spark, sf):
    product = W.build_dim_product(staging(spark, sf)["products"])
    return W.mart_product_category(fact(spark, sf), product).select("category", "units", dbl("revenue"), dbl("margin"))


@query("""SELECT p_partkey, p_name, CASE WHEN p_size > 30 THEN p_retailprice * 2 ELSE p_retailprice END AS p_retailprice FROM part""")
def publish_versions(spark, sf):
    """Upsert on top of a published version, published as the next one."""
    part = read(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice", "p_size")
    root, view = scratch_path(spark, "published"), "part_" + scratch_path(spark, "v").rsplit("-", 1)[-1]
    I.publish(part.where("p_size > 20").drop("p_size"), root, view)
    low = part.where("p_size <= 20").drop("p_size")
    raised = part.where("p_size > 30").withColumn("p_retailprice", F.col("p_retailprice") * 2).drop("p_size")
    I.publish(I.upsert_type1(spark.table(view), low.unionByName(raised), ["p_partkey"]), root, view)
    return spark.table(view)
