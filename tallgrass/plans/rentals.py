"""Rental marts: hosts, neighbourhoods, daily listing figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dim_host(listings: DataFrame, order: list[str]) -> DataFrame:
    """First known host name in the stated order, and distinct listings, per host."""
    named = F.when(F.col("host_name").isNotNull(), F.struct(*order, "host_name"))
    per_listing = listings.groupBy("host_id", "listing_id").agg(F.min(named).alias("_first"))
    return per_listing.groupBy("host_id").agg(
        F.min("_first")["host_name"].alias("host_name"), F.count("listing_id").alias("host_listings_count"))


def dim_neighbourhood(neighbourhoods: DataFrame) -> DataFrame:
    return neighbourhoods.select("neighbourhood", "neighbourhood_group").distinct()


def daily_metrics(calendar_fact: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct listings, average price and revenue of available nights.

    Nights are folded per listing first, so the distinct count is a plain count.
    """
    price = F.col("nightly_price")
    per_listing = calendar_fact.groupBy(*keys, "listing_id").agg(
        F.sum(price).alias("_sum"), F.count(price).alias("_n"),
        F.sum(F.when(F.col("is_available") == 1, price).otherwise(0)).alias("_open"))
    return per_listing.groupBy(*keys).agg(
        F.count("listing_id").alias("active_listings"),
        F.try_divide(F.sum("_sum").cast("double"), F.sum("_n")).alias("avg_nightly_price"),
        F.sum("_open").alias("total_potential_revenue"))


def host_performance(hosts: DataFrame, listings: DataFrame, reviews: DataFrame) -> DataFrame:
    """Reviews are counted per listing before they meet the listing table."""
    per_listing = reviews.groupBy("listing_id").agg(F.count(F.lit(1)).alias("total_reviews"))
    return host_figures(hosts, listings.select("listing_id", "host_id", "base_price").join(per_listing, "listing_id", "left"))


def host_figures(hosts: DataFrame, rated: DataFrame) -> DataFrame:
    """Listings, average price and reviews per host, from one row per listing."""
    per_host = rated.groupBy("host_id").agg(
        F.count("listing_id").alias("num_listings"), F.try_divide(F.sum("base_price").cast("double"), F.count("base_price")).alias("avg_listing_price"),
        F.coalesce(F.sum("total_reviews"), F.lit(0)).alias("total_reviews"))
    return hosts.select("host_id", "host_name").join(per_host, "host_id")
