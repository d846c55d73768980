"""Date and time functions. Dates are returned as ISO text."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.functions import dates as D
from tallgrass.queries import query, read

ISO = "yyyy-MM-dd HH:mm:ss"


def day(col, name):
    return F.date_format(col, "yyyy-MM-dd").alias(name)


def stamp(col, name):
    return F.date_format(col, ISO).alias(name)


@query("SELECT o_orderkey, date_diff('day', o_orderdate::DATE, DATE '2002-01-01') AS age, true AS clock FROM orders")
def dt_now(spark, sf):
    """Ages against a stated day; the clock itself is only checked for its order."""
    return read(spark, sf, "orders").select(
        "o_orderkey", F.datediff(F.lit("2002-01-01").cast("date"), "o_orderdate").cast("bigint").alias("age"),
        (F.current_timestamp().cast("date") >= F.date_sub(F.current_date(), 1)).alias("clock"))


@query("""
SELECT event_id, year(ts)::INT AS y, quarter(ts)::INT AS q, month(ts)::INT AS m, day(ts)::INT AS d, hour(ts)::INT AS h, minute(ts)::INT AS mi,
  second(ts)::INT AS s, weekofyear(ts)::INT AS w, (dayofweek(ts) + 1)::INT AS dow, dayofyear(ts)::INT AS doy FROM events""")
def dt_parts(spark, sf):
    ts = F.col("ts")
    return read(spark, sf, "events").select(
        "event_id", F.year(ts).alias("y"), F.quarter(ts).alias("q"), F.month(ts).alias("m"), F.dayofmonth(ts).alias("d"),
        F.hour(ts).alias("h"), F.minute(ts).alias("mi"), F.second(ts).alias("s"), F.weekofyear(ts).alias("w"),
        F.dayofweek(ts).alias("dow"), F.dayofyear(ts).alias("doy"))


@query("""
SELECT o_orderkey, strftime(last_day(o_orderdate), '%Y-%m-%d') AS month_end,
  strftime(o_orderdate::DATE + ((7 - isodow(o_orderdate)) % 7 + CASE WHEN isodow(o_orderdate) = 7 THEN 7 ELSE 0 END)::INT, '%Y-%m-%d') AS next_sunday FROM orders""")
def dt_month_end_next_day(spark, sf):
    return read(spark, sf, "orders").select(
        "o_orderkey", day(F.last_day("o_orderdate"), "month_end"), day(F.next_day("o_orderdate", "Sun"), "next_sunday"))


@query("""
SELECT o_orderkey, strftime(o_orderdate + INTERVAL 7 DAY, '%Y-%m-%d') AS later, strftime(o_orderdate - INTERVAL 3 DAY, '%Y-%m-%d') AS earlier,
  strftime(o_orderdate + INTERVAL 1 MONTH, '%Y-%m-%d') AS next_month FROM orders""")
def dt_shift(spark, sf):
    return read(spark, sf, "orders").select(
        "o_orderkey", day(F.date_add("o_orderdate", 7), "later"), day(F.date_sub("o_orderdate", 3), "earlier"),
        day(F.add_months("o_orderdate", 1), "next_month"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, date_diff('day', o_orderdate::DATE, l_shipdate::DATE) AS days,
  (12 * (year(l_shipdate) - year(o_orderdate)) + month(l_shipdate) - month(o_orderdate))::INT AS months,
  round(CASE WHEN day(l_shipdate) = day(o_orderdate) OR (l_shipdate::DATE = last_day(l_shipdate) AND o_orderdate::DATE = last_day(o_orderdate))
    THEN 12 * (year(l_shipdate) - year(o_orderdate)) + month(l_shipdate) - month(o_orderdate)
    ELSE 12 * (year(l_shipdate) - year(o_orderdate)) + month(l_shipdate) - month(o_orderdate) + (day(l_shipdate) - day(o_orderdate)) / 31.0 END, 6) AS between_months
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def dt_diff(spark, sf):
    joined = read(spark, sf, "lineitem").join(read(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    a, b = F.col("l_shipdate"), F.col("o_orderdate")
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", F.datediff(a, b).cast("bigint").alias("days"),
                         D.months_apart(a, b).alias("months"), F.round(F.months_between(a, b), 6).alias("between_months"))


_UNITS = ("year", "quarter", "month", "week", "day", "hour", "minute", "second")


@query("SELECT event_id, " + ", ".join(
    f"strftime(date_trunc('{u}', ts)::TIMESTAMP, '%Y-%m-%d %H:%M:%S') AS {u}" for u in _UNITS) + " FROM events")
def dt_trunc(spark, sf):
    return read(spark, sf, "events").select("event_id", *[stamp(F.date_trunc(u, "ts"), u) for u in _UNITS])


@query("""
SELECT o_orderkey, strftime(strptime(strftime(o_orderdate, '%m/%d/%Y'), '%m/%d/%Y'), '%Y-%m-%d') AS day,
  CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate + INTERVAL 90061 SECOND, '%Y-%m-%d %H:%M:%S') END AS moment FROM orders""")
def dt_parse(spark, sf):
    orders = read(spark, sf, "orders")
    text = F.date_format("o_orderdate", "MM/dd/yyyy")
    moment = F.date_format(F.col("o_orderdate") + F.expr("interval 90061 seconds"), "dd.MM.yyyy HH-mm-ss")
    moment = F.when(F.col("o_orderstatus") == "F", moment).otherwise("not a date")
    return orders.select("o_orderkey", text.alias("t"), moment.alias("m")).select(
        "o_orderkey", day(F.to_date("t", "MM/dd/yyyy"), "day"),
        stamp(D.parse_or_null(F.col("m"), "dd.MM.yyyy HH-mm-ss", r"^\d\d\.\d\d\.\d{4} "), "moment"))


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS key, strftime(o_orderdate, '%a') AS short, strftime(o_orderdate, '%A') AS long,
  strftime(o_orderdate, '%d %b %Y') AS text, strftime(o_orderdate, '%m.%y') AS month FROM orders""")
def dt_format(spark, sf):
    return read(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("key"), F.date_format("o_orderdate", "E").alias("short"),
        F.date_format("o_orderdate", "EEEE").alias("long"), F.date_format("o_orderdate", "dd MMM yyyy").alias("text"),
        F.date_format("o_orderdate", "MM.yy").alias("month"))


@query("""
SELECT event_id, strftime((ts + INTERVAL 180 DAY) AT TIME ZONE 'Europe/Berlin' AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS utc_summer,
  strftime(ts AT TIME ZONE 'Europe/Berlin' AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS utc_winter,
  strftime(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/Toronto', '%Y-%m-%d %H:%M:%S') AS toronto FROM events""")
def dt_timezone(spark, sf):
    """Winter and summer of the same events, so both offsets are exercised."""
    ts, summer = F.col("ts"), F.col("ts") + F.expr("interval 180 days")

    def shift(col, source, target):
        return F.convert_timezone(F.lit(source), F.lit(target), col)

    return read(spark, sf, "events").select(
        "event_id", stamp(shift(summer, "Europe/Berlin", "UTC"), "utc_summer"),
        stamp(shift(ts, "Europe/Berlin", "UTC"), "utc_winter"), stamp(shift(ts, "UTC", "America/Toronto"), "toronto"))


@query("""SELECT event_id, floor(epoch(ts))::BIGINT AS unix, strftime(to_timestamp(floor(epoch(ts))::BIGINT) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS back FROM events""")
def dt_unix(spark, sf):
    moment = F.unix_timestamp(F.date_format("ts", ISO), ISO)
    return read(spark, sf, "events").select("event_id", moment.alias("unix"), F.from_unixtime(moment, ISO).alias("back"))


@query("""
SELECT o_orderkey, isoyear(o_orderdate)::INT AS y, weekofyear(o_orderdate)::INT AS w, strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') AS week_start FROM orders""")
def dt_iso_week_start(spark, sf):
    parts = read(spark, sf, "orders").select(
        "o_orderkey", F.extract(F.lit("YEAROFWEEK"), "o_orderdate").cast("int").alias("y"), F.weekofyear("o_orderdate").alias("w"))
    return parts.withColumn("week_start", F.date_format(D.iso_week_start(F.col("y"), F.col("w")), "yyyy-MM-dd"))


@query("""SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month,
  strftime(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH, '%Y-%m-%d') AS next_month FROM orders""")
def dt_month_floor(spark, sf):
    return read(spark, sf, "orders").select(
        "o_orderkey", day(D.month_floor(F.col("o_orderdate")), "month"), day(D.next_month(F.col("o_orderdate")), "next_month"))


@query("SELECT event_id, round(epoch_us(ts - TIMESTAMP '1899-12-30') / 86400000000.0, 8) AS serial FROM (SELECT event_id, ts FROM events)")
def dt_serial_day(spark, sf):
    return read(spark, sf, "events").select("event_id", F.round(D.serial_day(F.col("ts")), 8).alias("serial"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%A') AS name FROM orders")
def dt_fill_weekday_name(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", D.full_day_name(F.date_format("o_orderdate", "E")).alias("name"))
