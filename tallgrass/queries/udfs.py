"""User-defined functions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tallgrass.operators import udfs as U
from tallgrass.queries import query, read


@query("""SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1:1]) || x[2:]), ' ') AS name FROM part""")
def udf_scalar(spark, sf):
    return read(spark, sf, "part").select("p_partkey", U.text_udf(U.capitalize_each_word)(F.col("p_name")).alias("name"))


@query("""
SELECT c_custkey, CASE WHEN c_acctbal >= 8000 THEN 'Platinum' WHEN c_acctbal >= 5000 THEN 'Gold' WHEN c_acctbal >= 1000 THEN 'Silver' ELSE 'Bronze' END AS level FROM customer""")
def apply_row_rule(spark, sf):
    b = F.col("c_acctbal")
    level = F.when(b >= 8000, "Platinum").when(b >= 5000, "Gold").when(b >= 1000, "Silver").otherwise("Bronze")
    return read(spark, sf, "customer").select("c_custkey", level.alias("level"))


@query("SELECT count(*)::BIGINT AS handled FROM customer")
def foreach_row(spark, sf):
    handled = U.foreach_batch_of_rows(read(spark, sf, "customer").select("c_custkey"), lambda batch: None)
    return handled.agg(F.sum("handled").alias("handled"))


def _line(pdf: pd.DataFrame) -> pd.DataFrame:
    slope, start = np.polyfit(pdf["t"].to_numpy(float), pdf["sales"].to_numpy(float), 1)
    return pd.DataFrame({"c_mktsegment": [pdf["c_mktsegment"].iloc[0]], "slope": [slope], "start": [start]})


@query("""
SELECT c_mktsegment, round(regr_slope(sales, t), 2) AS slope, round(regr_intercept(sales, t), 2) AS start FROM (
  SELECT c_mktsegment, (12 * year(o_orderdate) + month(o_orderdate) - 12 * 1995 - 1)::DOUBLE AS t, sum(o_totalprice) AS sales
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL) GROUP BY c_mktsegment""")
def group_map(spark, sf):
    """A trend line per segment; each group holds one row per month."""
    t = (F.year("o_orderdate") * 12 + F.month("o_orderdate") - (12 * 1995 + 1)).cast("double")
    monthly = (read(spark, sf, "orders").join(read(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
               .groupBy("c_mktsegment", t.alias("t")).agg(F.sum("o_totalprice").alias("sales")))
    out = U.group_map(monthly, ["c_mktsegment"], _line, "c_mktsegment string, slope double, start double")
    return out.select("c_mktsegment", F.round("slope", 2).alias("slope"), F.round("start", 2).alias("start"))
