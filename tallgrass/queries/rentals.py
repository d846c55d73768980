"""Rental warehouse: upsert, high-water append, daily and host marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.operators.windows import latest_per_key
from tallgrass.plans import incremental as I
from tallgrass.plans import rentals as R
from tallgrass.plans import staged as S
from tallgrass.queries import query, read
from tallgrass.session import materialize, scratch_path


def iso(col):
    return F.date_format(col, "yyyy-MM-dd").alias(col)


def listings(spark, sf):
    """Every line item is one snapshot of a listing (part) by a host (supplier)."""
    host = read(spark, sf, "supplier").select(F.col("s_suppkey").alias("host_id"),
                                              F.when(F.col("s_acctbal") > 0, F.col("s_name")).alias("host_name"), "s_nationkey")
    rows = read(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("listing_id"), F.col("l_suppkey").alias("host_id"), F.col("l_extendedprice").alias("price"),
        F.to_date("l_shipdate").alias("snapshot_date"), "l_orderkey", "l_linenumber", "l_returnflag")
    return rows.join(host, "host_id")


LISTINGS = """
SELECT l_partkey AS listing_id, l_suppkey AS host_id, l_extendedprice AS price, l_shipdate::DATE AS snapshot_date, l_orderkey, l_linenumber,
  CASE WHEN s_acctbal > 0 THEN s_name END AS host_name, s_nationkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""
_LATEST = f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY snapshot_date DESC, l_orderkey, l_linenumber, host_id, price) AS rn
FROM ({LISTINGS})) WHERE rn = 1"""


def current(df):
    return latest_per_key(df, ["listing_id"], "snapshot_date", ["l_orderkey", "l_linenumber", "host_id", "price"]).select(
        "listing_id", "host_id", F.col("price").alias("base_price"), "snapshot_date")


@query(f"""SELECT listing_id, host_id, price AS base_price, strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date FROM ({_LATEST})""")
def dim_upsert_type1(spark, sf):
    """A first load up to 1998, then the later snapshots merged into a stored table, part by part."""
    rows, folder = listings(spark, sf), scratch_path(spark, "dim_listing")
    for load in ("snapshot_date < DATE'1998-01-01'", "snapshot_date >= DATE'1998-01-01'"):
        S.upsert_staged(materialize(current(rows.where(load))), folder, ["listing_id"], S.by_hash(["listing_id"], 16))
    out = S.read_staged(spark, folder, "listing_id long, host_id long, base_price double, snapshot_date date")
    return out.withColumn("snapshot_date", iso("snapshot_date"))


@query(f"SELECT host_id, min(host_name) AS host_name, count(DISTINCT listing_id) AS host_listings_count FROM ({LISTINGS}) GROUP BY host_id")
def dim_host(spark, sf):
    return R.dim_host(listings(spark, sf), ["snapshot_date", "l_orderkey", "l_linenumber"])


@query("SELECT DISTINCT n_name AS neighbourhood, r_name AS neighbourhood_group FROM nation JOIN region ON n_regionkey = r_regionkey JOIN supplier ON s_nationkey = n_nationkey")
def dim_neighbourhood(spark, sf):
    rows = (read(spark, sf, "supplier").join(read(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(read(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")))
    return R.dim_neighbourhood(rows.select(F.col("n_name").alias("neighbourhood"), F.col("r_name").alias("neighbourhood_group")))


def calendar_fact(spark, sf, since=None, before=None):
    """Nights after a date, or before another; both limits are on the stored column, so they reach the scan."""
    rows = read(spark, sf, "lineitem")
    if since is not None:
        rows = rows.where(F.col("l_shipdate") >= F.date_add(since, 1).cast("timestamp_ntz"))
    if before is not None:
        rows = rows.where(F.col("l_shipdate") < F.lit(before).cast("timestamp_ntz"))
    return rows.select(
        F.col("l_partkey").alias("listing_id"), F.to_date("l_shipdate").alias("date"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("is_available"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("nightly_price"), "l_suppkey")


NIGHTS = """
SELECT l_partkey AS listing_id, l_shipdate::DATE AS date, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS is_available,
  l_extendedprice::DECIMAL(18,2) AS nightly_price, l_suppkey FROM lineitem"""


@query(f"""
WITH f AS ({NIGHTS}), t AS (SELECT * FROM f WHERE date < DATE '1998-06-15' AND is_available = 1)
SELECT listing_id, strftime(date, '%Y-%m-%d') AS date, is_available, nightly_price::DOUBLE AS nightly_price
FROM (SELECT * FROM t UNION ALL SELECT * FROM f WHERE date > (SELECT max(date) FROM t))""")
def fact_incremental_append(spark, sf):
    stored = calendar_fact(spark, sf, before="1998-06-15").where("is_available = 1")
    later = calendar_fact(spark, sf, since=I.high_water(stored, "date"))
    return stored.unionByName(later).select(
        "listing_id", iso("date"), "is_available", F.col("nightly_price").cast("double").alias("nightly_price"))


def _daily_sql(extra="", join=""):
    return f"""
SELECT strftime(date, '%Y-%m-%d') AS date{extra}, count(DISTINCT listing_id) AS active_listings,
  round(sum(nightly_price)::DOUBLE / count(nightly_price), 7) AS avg_nightly_price,
  sum(CASE WHEN is_available = 1 THEN nightly_price ELSE 0 END)::DOUBLE AS total_potential_revenue
FROM ({NIGHTS}) {join} GROUP BY ALL"""


def _shown(df, *keys):
    return df.select(iso("date"), *keys, "active_listings", F.round("avg_nightly_price", 7).alias("avg_nightly_price"),
                     F.col("total_potential_revenue").cast("double").alias("total_potential_revenue"))


@query(_daily_sql())
def mart_city_daily(spark, sf):
    """Two incremental runs; the second adds only days after the first run's last."""
    first = materialize(R.daily_metrics(calendar_fact(spark, sf, before="1998-06-15"), ["date"]))
    later = calendar_fact(spark, sf, since=I.high_water(first, "date"))
    return _shown(first.unionByName(R.daily_metrics(later, ["date"])))


@query(_daily_sql(", n_name AS neighbourhood", "JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"))
def mart_neighbourhood_daily(spark, sf):
    place = read(spark, sf, "supplier").join(read(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("neighbourhood"))
    keys = ["date", "neighbourhood"]
    first = materialize(R.daily_metrics(calendar_fact(spark, sf, before="1998-06-15").join(place, "l_suppkey"), keys))
    later = calendar_fact(spark, sf, since=I.high_water(first, "date")).join(place, "l_suppkey")
    return _shown(first.unionByName(R.daily_metrics(later, keys)), "neighbourhood")


@query(f"""
WITH r AS (SELECT l_partkey AS listing_id, count(*) AS total_reviews FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
h AS (SELECT host_id, min(host_name) AS host_name FROM ({LISTINGS}) GROUP BY 1)
SELECT h.host_id, h.host_name, count(DISTINCT l.listing_id) AS num_listings, round(sum(l.price::DECIMAL(18,2))::DOUBLE / count(l.price), 6) AS avg_listing_price,
  coalesce(sum(r.total_reviews), 0)::BIGINT AS total_reviews
FROM h JOIN ({_LATEST}) l USING (host_id) LEFT JOIN r USING (listing_id) GROUP BY h.host_id, h.host_name""")
def mart_host_performance(spark, sf):
    """Snapshots are folded once per host and listing; hosts, listings and reviews all come from the folded rows."""
    order = ["snapshot_date", "l_orderkey", "l_linenumber"]
    newest = [-F.unix_date("snapshot_date"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("host_id"), F.col("price").cast("decimal(18,2)")]
    names = [f"k{i}" for i in range(len(newest))]
    known = F.when(F.col("host_name").isNotNull(), F.struct(*order, "host_name"))
    folded = materialize(listings(spark, sf).groupBy("host_id", "listing_id").agg(
        F.min(known).alias("first"), F.min(F.struct(*[c.alias(n) for c, n in zip(newest, names, strict=True)])).alias("newest"),
        F.count_if(F.col("l_returnflag") == "R").alias("reviews")))
    hosts = folded.groupBy("host_id").agg(F.min("first")["host_name"].alias("host_name"))
    per_listing = folded.groupBy("listing_id").agg(F.min("newest").alias("newest"), F.sum("reviews").alias("total_reviews"))
    current_rows = per_listing.select("listing_id", F.col("newest.k3").alias("host_id"), F.col("newest.k4").alias("base_price"), "total_reviews")
    return R.host_figures(hosts, current_rows).withColumn("avg_listing_price", F.round("avg_listing_price", 6))
