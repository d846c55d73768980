"""Business measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.operators import aggregates as A
from tallgrass.plans import measures as M
from tallgrass.queries import query, read


def iso(col):
    return F.date_format(col, "yyyy-MM-dd").alias(col)


def dbl(col):
    return F.col(col).cast("double").alias(col)


def star(spark, sf):
    """Line items as sales; returned lines carry a negative quantity."""
    lines = read(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), F.to_date("l_shipdate").alias("ship_date"),
        F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("sales"), F.col("l_linestatus").alias("line_status"))
    orders = read(spark, sf, "orders").select(
        F.col("o_orderkey"), F.col("o_custkey").alias("customer_id"), F.to_date("o_orderdate").alias("order_date"),
        F.col("o_orderpriority").alias("priority"))
    part = read(spark, sf, "part").select(
        F.col("p_partkey"), "p_type", "p_brand", F.split_part("p_name", F.lit(" "), F.lit(1)).alias("colour"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("cost_each"))
    customer = read(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    nation = read(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read(spark, sf, "region")
    return M.Star(lines, {
        "order": (orders, "order_id", "o_orderkey", "inner"), "product": (part, "product_id", "p_partkey", "inner"),
        "customer": (customer, "customer_id", "c_custkey", "inner"), "nation": (nation, "c_nationkey", "n_nationkey", "inner"),
        "region": (region, "n_regionkey", "r_regionkey", "inner")})


STAR = """(SELECT l_orderkey AS order_id, l_partkey AS product_id, l_shipdate::DATE AS ship_date,
  (CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END)::INT AS quantity, l_extendedprice::DECIMAL(18,2) AS sales, l_linestatus AS line_status,
  o_custkey AS customer_id, o_orderdate::DATE AS order_date, o_orderpriority AS priority, p_type, p_brand, split_part(p_name, ' ', 1) AS colour,
  p_retailprice::DECIMAL(18,2) AS cost_each, c_mktsegment, n_name, r_name
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
MONTHS = f"(SELECT date_trunc('month', order_date)::DATE AS month, sum(sales) AS sales FROM {STAR} GROUP BY 1)"


def by_order(spark, sf):
    """Sales folded per order, then placed on its date."""
    s = star(spark, sf)
    per = M.Star(s.fact.groupBy("order_id").agg(F.sum("sales").alias("sales")), s.dims)
    return per.joined("order")


def by_customer(spark, sf):
    s = star(spark, sf)
    per = s.fact.groupBy("order_id").agg(F.sum("sales").alias("sales"))
    folded = M.Star(per, s.dims).joined("order").groupBy("customer_id").agg(F.sum("sales").alias("sales"))
    return M.Star(folded, s.dims)


@query(f"SELECT product_id, sales::DOUBLE AS sales FROM (SELECT product_id, sum(sales) AS sales, rank() OVER (ORDER BY sum(sales) DESC) AS rk FROM {STAR} GROUP BY 1) WHERE rk = 1")
def m_top_product(spark, sf):
    return M.top_with_ties(M.totals(star(spark, sf).fact, "product_id", "sales", "sales"), "sales", 1).select("product_id", dbl("sales"))


@query(f"""
WITH p AS (SELECT product_id, sum(sales) AS sales, rank() OVER (ORDER BY sum(sales) DESC) AS rk FROM {STAR} GROUP BY 1)
SELECT sum(sales) FILTER (rk <= 5)::DOUBLE AS top, count(*) FILTER (rk <= 5) AS members, round(sum(sales) FILTER (rk <= 5)::DOUBLE / sum(sales)::DOUBLE, 9) AS share FROM p""")
def m_top5_share(spark, sf):
    out = M.top_share(M.totals(star(spark, sf).fact, "product_id", "sales", "sales"), "sales", 5)
    return out.select(dbl("top"), "members", F.round("share", 9).alias("share"))


@query(f"""SELECT strftime(a.month, '%Y-%m-%d') AS month, a.sales::DOUBLE AS sales, b.sales::DOUBLE AS last_year, (a.sales - b.sales)::DOUBLE AS variance
FROM {MONTHS} a LEFT JOIN {MONTHS} b ON b.month = (a.month - INTERVAL 12 MONTH)::DATE""")
def m_yoy_variance(spark, sf):
    return M.yoy_variance(M.monthly(by_order(spark, sf), "order_date", "sales")).select(iso("month"), dbl("sales"), dbl("last_year"), dbl("variance"))


@query("""
WITH c AS (SELECT o_custkey, min(year(o_orderdate)) AS first, count(*) FILTER (year(o_orderdate) = 1996) AS n FROM orders GROUP BY 1)
SELECT count(*) FILTER (first = 1996) AS first_purchase, count(*) FILTER (n = 1) AS single_row FROM c""")
def m_new_customers(spark, sf):
    return M.new_customers(read(spark, sf, "orders"), "o_custkey", "o_orderdate", 1996)


@query(f"SELECT p_type, round(count(*) FILTER (quantity < 0) / count(*), 9) AS return_rate FROM {STAR} GROUP BY 1")
def m_return_rate(spark, sf):
    return M.measure(["return_rate"], star(spark, sf), ["p_type"], via=["product"]).withColumn("return_rate", F.round("return_rate", 9))


@query(f"SELECT count(*) FILTER (sales > (SELECT avg(sales) FROM {MONTHS})) AS months_above, count(*) AS months FROM {MONTHS}")
def m_months_above_avg(spark, sf):
    return M.months_above_average(M.monthly(by_order(spark, sf), "order_date", "sales"))


@query(f"SELECT p_type, round(sum(sales)::DOUBLE / (sum(cost_each * quantity)::DOUBLE / count(*)), 4) AS inventory_turnover FROM {STAR} GROUP BY 1")
def m_inventory_turnover(spark, sf):
    return M.measure(["inventory_turnover"], star(spark, sf), ["p_type"], via=["product"]).withColumn(
        "inventory_turnover", F.round("inventory_turnover", 4))


@query(f"SELECT c_mktsegment, round(count(*) FILTER (quantity > 1) / count(DISTINCT customer_id), 9) AS loyalty_index FROM {STAR} GROUP BY 1")
def m_loyalty_index(spark, sf):
    return M.measure(["loyalty_index"], star(spark, sf), ["c_mktsegment"], via=["order", "customer"]).withColumn(
        "loyalty_index", F.round("loyalty_index", 9))


@query(f"""
WITH q AS (SELECT date_trunc('quarter', order_date)::DATE AS quarter, sum(sales) AS sales FROM {STAR} GROUP BY 1)
SELECT strftime(quarter, '%Y-%m-%d') AS quarter, sales::DOUBLE AS sales,
  round((sales - lag(sales) OVER (ORDER BY quarter))::DOUBLE / (lag(sales) OVER (ORDER BY quarter))::DOUBLE, 9) AS growth FROM q""")
def m_qoq_growth(spark, sf):
    out = M.quarterly_growth(by_order(spark, sf), "order_date", "sales")
    return out.select(iso("quarter"), dbl("sales"), F.round("growth", 9).alias("growth"))


@query(f"SELECT priority, round(avg(date_diff('day', order_date, ship_date)), 6) AS days_to_ship FROM {STAR} GROUP BY 1")
def m_avg_days_to_ship(spark, sf):
    return M.measure(["days_to_ship"], star(spark, sf), ["priority"], via=["order"]).withColumn("days_to_ship", F.round("days_to_ship", 6))


@query(f"""SELECT CASE WHEN cost_each > 1000 THEN 'High' ELSE 'Low' END AS band, count(*) AS n,
  round(sum(sales - quantity * cost_each)::DOUBLE / count(*), 6) AS profit FROM {STAR} GROUP BY 1""")
def m_high_low(spark, sf):
    s = star(spark, sf).joined("product")
    rows = s.withColumn("profit", (F.col("sales") - F.col("quantity") * F.col("cost_each")).cast("double"))
    return M.price_bands(rows, "cost_each", 1000, ["profit"]).withColumn("profit", F.round("profit", 6))


@query(f"SELECT c_mktsegment, sum(sales - quantity * cost_each)::DOUBLE AS profit FROM {STAR} GROUP BY 1")
def m_profit(spark, sf):
    return M.measure(["profit"], star(spark, sf), ["c_mktsegment"], via=["product", "order", "customer"]).select(
        "c_mktsegment", dbl("profit"))


@query(f"""
WITH c AS (SELECT p_type, sum(sales) AS sales, sum(quantity * cost_each) AS cost FROM {STAR} GROUP BY 1)
SELECT p_type, sales::DOUBLE AS sales, cost::DOUBLE AS cost, (sales - cost)::DOUBLE AS profit, round(avg(sales::DOUBLE) OVER (), 4) AS average FROM c""")
def m_category_bars(spark, sf):
    per = M.measure(["sales", "cost", "profit"], star(spark, sf), ["p_type"], via=["product"]).orderBy(F.desc("sales"))
    out = per.select("p_type", dbl("sales"), dbl("cost"), dbl("profit"))
    return A.beside_average(out, "sales", "average").withColumn("average", F.round("average", 4))


@query(f"SELECT (year(order_date) + CASE WHEN month(order_date) >= 7 THEN 1 ELSE 0 END)::INT AS fiscal_year, sum(sales)::DOUBLE AS sales FROM {STAR} GROUP BY 1")
def m_fiscal_trend(spark, sf):
    """The fiscal year starts in July."""
    fiscal = F.year(F.add_months("order_date", 6)).alias("fiscal_year")
    return by_order(spark, sf).groupBy(fiscal).agg(F.sum("sales").cast("double").alias("sales"))


@query(f"SELECT r_name, sum(sales)::DOUBLE AS sales, round(sum(sales)::DOUBLE / (SELECT sum(sales)::DOUBLE FROM {STAR}), 9) AS share FROM {STAR} GROUP BY 1")
def m_region_share(spark, sf):
    per = by_customer(spark, sf).joined("customer", "nation", "region").groupBy("r_name").agg(F.sum("sales").cast("double").alias("sales"))
    return M.with_share(per, "sales").withColumn("share", F.round("share", 9))


@query(f"SELECT coalesce(c_mktsegment, 'Total') AS c_mktsegment, sum(sales)::DOUBLE AS sales FROM {STAR} GROUP BY ROLLUP (c_mktsegment)")
def m_business_type_total(spark, sf):
    joined = by_customer(spark, sf).joined("customer")
    out = A.subtotals(joined, ["c_mktsegment"], [F.sum("sales").cast("double").alias("sales")])
    return out.select(F.when(F.col("level") == 1, "Total").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"), "sales").orderBy("sales")


@query(f"SELECT colour, sum(quantity * cost_each)::DOUBLE AS cost FROM {STAR} GROUP BY 1")
def m_color_cost(spark, sf):
    out = M.measure(["cost"], star(spark, sf), ["colour"], via=["product"])
    return out.select("colour", dbl("cost")).orderBy(F.desc("cost"))


@query("""
WITH e AS (SELECT user_id, event_type, count(*) AS n FROM events WHERE event_type IN ('purchase', 'signup', 'click') GROUP BY ALL)
SELECT user_id, CASE event_type WHEN 'purchase' THEN 'Gold' WHEN 'signup' THEN 'Silver' ELSE 'Bronze' END AS medal, n AS won FROM e
UNION ALL SELECT user_id, 'Total', sum(n)::BIGINT FROM e GROUP BY user_id""")
def m_medal_totals(spark, sf):
    """Counts per user as columns with their total, turned into rows."""
    names = {"purchase": "Gold", "signup": "Silver", "click": "Bronze"}
    wide = read(spark, sf, "events").groupBy("user_id").agg(
        *[F.count_if(F.col("event_type") == t).alias(m) for t, m in names.items()])
    wide = wide.withColumn("Total", F.col("Gold") + F.col("Silver") + F.col("Bronze"))
    return A.unpivot_measures(wide, ["user_id"], ["Gold", "Silver", "Bronze", "Total"], "medal", "won").where("won > 0")


@query("""SELECT label, round(avg(embedding[1]::DOUBLE), 9) AS x, round(avg(embedding[2]::DOUBLE), 9) AS y, count(*) AS n FROM embeddings GROUP BY label""")
def m_map_points(spark, sf):
    return read(spark, sf, "embeddings").groupBy("label").agg(
        F.round(F.avg(F.col("embedding")[0].cast("double")), 9).alias("x"),
        F.round(F.avg(F.col("embedding")[1].cast("double")), 9).alias("y"), F.count(F.lit(1)).alias("n"))
