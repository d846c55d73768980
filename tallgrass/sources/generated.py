"""Sources Spark computes itself: ranges, calendars, literal rows, seeded sales."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def number_range(spark: SparkSession, n: int, name: str = "number") -> DataFrame:
    return spark.range(n).toDF(name)


def inline_rows(spark: SparkSession, rows, schema) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def calendar_columns(date: Column) -> list[Column]:
    return [
        F.date_format(date, "yyyyMMdd").cast("int").alias("date_key"),
        date.alias("date"),
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        F.dayofmonth(date).alias("day"),
        F.weekofyear(date).alias("week_of_year"),
        F.date_format(date, "E").alias("day_name"),
    ]


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    days = F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("d")).select(*calendar_columns(F.col("d")))


def calendar_of(df: DataFrame, date_col: str) -> DataFrame:
    """Calendar from the first to the last date of a column; one row per day."""
    day = F.to_date(F.col(date_col))
    ends = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    days = F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("d")
    return ends.select(days).select(*calendar_columns(F.col("d")))


def _pick(seed: int, salt: str, n) -> Column:
    """Reproducible integer in ``[0, n)`` from the row id."""
    return F.pmod(F.xxhash64(F.col("id"), F.lit(seed), F.lit(salt)), F.lit(n))


def synthetic_sales(spark: SparkSession, *, customers: int = 3_000, products: int = 200,
                    orders: int = 10_000, items: int = 20_000, seed: int = 42) -> dict[str, DataFrame]:
    """Seeded customers, products, orders and order items, generated on the executors from row numbers."""
    buyer, order, product = (_pick(seed, salt, n) + 1 for salt, n in (("buyer", customers), ("order_of", orders), ("product_of", products)))
    own = F.col("id") + 1
    return sales_of(
        spark.range(customers).select("id", own.alias("customer_id")), spark.range(products).select("id", own.alias("product_id")),
        spark.range(orders).select("id", own.alias("order_id"), buyer.alias("customer_id")),
        spark.range(items).select("id", own.alias("order_item_id"), order.alias("order_id"), product.alias("product_id")), seed=seed)


def sales_of(customers: DataFrame, products: DataFrame, orders: DataFrame, items: DataFrame, *, seed: int = 42) -> dict[str, DataFrame]:
    """Seeded values for given keys: which customer ordered what stays as it is given.

    ``customers`` has customer_id, ``products`` product_id, ``orders`` order_id and customer_id,
    ``items`` order_item_id, order_id and product_id, each also an ``id`` that its values come
    from: every value is a hash of that and the seed, so a lost task makes the same rows again.
    """
    # Fixed values.
    countries = ["Canada", "USA", "UK", "Germany", "France"]
    channels = ["email", "search", "social", "referral"]
    categories = ["Electronics", "Home", "Sports", "Beauty", "Toys"]
    statuses = ["completed", "shipped", "cancelled"]

    def one_of(values, salt):
        return F.element_at(F.array(*[F.lit(v) for v in values]),
                            (_pick(seed, salt, len(values)) + 1).cast("int"))

    def money(low, high, salt):
        return (F.lit(low) + _pick(seed, salt, (high - low) * 100) / 100).cast("decimal(18,2)")

    def day(salt):
        return F.date_add(F.lit("2022-01-01").cast("date"), _pick(seed, salt, 3 * 365).cast("int"))

    cust = customers.select(
        "customer_id", F.concat(F.lit("First"), "id").alias("first_name"),
        F.concat(F.lit("Last"), "id").alias("last_name"),
        F.concat(F.lit("user"), "id", F.lit("@example.com")).alias("email"),
        day("signup").cast("timestamp_ntz").alias("created_ts"),
        one_of(countries, "country").alias("country"), one_of(channels, "channel").alias("marketing_channel"))
    prod = products.select(
        "product_id", F.concat(F.lit("Product "), "id").alias("product_name"),
        one_of(categories, "category").alias("category"), F.concat(F.lit("Brand "), _pick(seed, "brand", 20)).alias("brand"),
        money(10, 500, "price").alias("current_price"), money(5, 300, "cost").alias("cost"))
    head = orders.select(
        "order_id", "customer_id",
        day("order").cast("timestamp_ntz").alias("order_ts"), one_of(statuses, "status").alias("order_status"),
        F.lit("CAD").alias("currency"), money(20, 1000, "total").alias("total_amount"))
    line = items.select(
        "order_item_id", "order_id", "product_id", (_pick(seed, "qty", 4) + 1).alias("quantity"),
        money(10, 500, "unit").alias("unit_price"), money(0, 20, "off").alias("discount_amount"))
    return {"customers": cust, "products": prod, "orders": head, "order_items": line}
