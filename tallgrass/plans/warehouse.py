"""Star-schema warehouse: typed dimensions, order-item fact, data marts.

Amounts are ``decimal(18,2)``, so sums are exact in any order. Marts aggregate the
fact by its own key before joining a dimension: the join then moves one row per key
and a hot key costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def amount(name: str) -> Column:
    return F.col(name).cast(MONEY)


def build_dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select(
        F.col("customer_id").cast("string").alias("customer_id"), "first_name", "last_name", "email", "country",
        "marketing_channel", "created_ts", F.to_date("created_ts").alias("signup_date"))


def build_dim_product(products: DataFrame) -> DataFrame:
    return products.select(
        F.col("product_id").cast("string").alias("product_id"), "product_name", "category", "brand",
        amount("current_price").alias("current_price"), amount("cost").alias("cost"))


def date_key(date: Column) -> Column:
    """The calendar's key of a date, ``yyyyMMdd`` as a number."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.day(date)


def build_fact_order_items(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Order items with gross, discount, net, cost and margin; cost and margin are
    null for an unknown product.

    Joins run on the keys as given and cast them afterwards. The date key is computed
    from the date, as a calendar over the orders' days would have it; no calendar is joined.
    """
    head = orders.select("order_id", "customer_id", "order_status", "currency", F.to_date("order_ts").alias("order_date"))
    cost = products.select("product_id", amount("cost").alias("cost"))
    quantity = F.col("quantity").cast("int")
    gross = quantity * amount("unit_price")
    net = gross - amount("discount_amount")
    return (
        items.join(head, "order_id")
        .join(cost, "product_id", "left")
        .select(
            F.col("order_item_id").cast("string").alias("order_item_id"), F.col("order_id").cast("string").alias("order_id"),
            F.col("customer_id").cast("string").alias("customer_id"), F.col("product_id").cast("string").alias("product_id"),
            date_key(F.col("order_date")).alias("order_date_key"), "order_date",
            "order_status", "currency", quantity.alias("quantity"), amount("unit_price").alias("unit_price"),
            amount("discount_amount").alias("discount_amount"), gross.alias("extended_gross"),
            amount("discount_amount").alias("extended_discount"), net.alias("extended_net"),
            (quantity * F.col("cost")).alias("cost_amount"), (net - quantity * F.col("cost")).alias("margin_amount")))


def mart_sales_daily(fact: DataFrame) -> DataFrame:
    """Revenue, margin and distinct orders per day; each order is folded to one row first.
    Orders without a date belong to no day."""
    per_order = fact.where(F.col("order_date").isNotNull()).groupBy(F.col("order_date").alias("date"), "order_id").agg(
        F.sum("extended_net").alias("_net"), F.sum("margin_amount").alias("_margin"))
    return per_order.groupBy("date").agg(
        F.sum("_net").alias("revenue"), F.sum("_margin").alias("margin"), F.count("order_id").alias("orders"))


def mart_marketing_channel(fact: DataFrame, customer: DataFrame) -> DataFrame:
    per_customer = fact.groupBy("customer_id").agg(
        F.sum("extended_net").alias("_net"), F.sum("margin_amount").alias("_margin"))
    return per_customer.join(customer.select("customer_id", "marketing_channel"), "customer_id").groupBy(
        "marketing_channel").agg(F.sum("_net").alias("revenue"), F.sum("_margin").alias("margin"),
                                 F.count("customer_id").alias("customers"))


def mart_product_category(fact: DataFrame, product: DataFrame) -> DataFrame:
    per_product = fact.groupBy("product_id").agg(
        F.sum("quantity").alias("_q"), F.sum("extended_net").alias("_net"), F.sum("margin_amount").alias("_margin"))
    return per_product.join(product.select("product_id", "category"), "product_id").groupBy("category").agg(
        F.sum("_q").alias("units"), F.sum("_net").alias("revenue"), F.sum("_margin").alias("margin"))
