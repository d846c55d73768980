"""Sort, limit, top-k, sampling and distribution."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.operators import ordered as O
from tallgrass.operators import sampling as S
from tallgrass.operators import windows as W
from tallgrass.queries import query, read
from tallgrass.session import materialize

_DRAW = "(('0x' || substr(md5({id} || ':{seed}'), 1, 8))::BIGINT / 4294967296.0)"


@query("""
SELECT o_orderkey, o_orderpriority, o_totalprice,
       row_number() OVER (ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey) - 1 AS position FROM orders""")
def sort_multi(spark, sf):
    """The place in the order is returned, so the check sees the order itself."""
    orders = read(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return O.with_position(orders, [F.asc("o_orderpriority"), F.desc("o_totalprice"), F.asc("o_orderkey")])


@query("""
SELECT n_name, sum(l_quantity) AS quantity FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name ORDER BY quantity DESC, n_name LIMIT 5""")
def topk_group_total(spark, sf):
    per_supplier = read(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("q"))
    return (per_supplier.join(read(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .join(read(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .groupBy("n_name").agg(F.sum("q").alias("quantity"))
            .orderBy(F.desc("quantity"), "n_name").limit(5))


@query("""
SELECT p_type, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS sales,
  row_number() OVER (ORDER BY sum(l_extendedprice::DECIMAL(18,2)) DESC, p_type) - 1 AS place
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type""")
def sort_by_measure(spark, sf):
    sales = (read(spark, sf, "lineitem").groupBy("l_partkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("s"))
             .join(read(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
             .groupBy("p_type").agg(F.sum("s").alias("sales")))
    return O.with_position(sales, [F.desc("sales"), F.asc("p_type")], "place").withColumn("sales", F.col("sales").cast("double"))


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(spark, sf):
    return read(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (SELECT *, row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice DESC, l_partkey, l_suppkey) AS rn FROM lineitem) WHERE rn = 1""")
def dedupe_subset(spark, sf):
    return W.first_rows(read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"],
                        [F.desc("l_extendedprice"), "l_partkey", "l_suppkey"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query(f"""
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE {_DRAW.format(id="l_orderkey || '-' || l_linenumber", seed=5)} < 0.1""")
def sample_fraction(spark, sf):
    lines = read(spark, sf, "lineitem").withColumn("id", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    return S.sample_fraction(lines, 0.1, id_col="id", seed=5).select("l_orderkey", "l_linenumber")


@query("""
SELECT c_mktsegment, c_custkey FROM (SELECT *, row_number() OVER (
  PARTITION BY c_mktsegment ORDER BY md5(c_custkey || ':22'), c_custkey) AS rn FROM customer) WHERE rn <= 20""")
def sample_n_per_group(spark, sf):
    return S.sample_n(read(spark, sf, "customer"), ["c_mktsegment"], 20, id_col="c_custkey", seed=22).select(
        "c_mktsegment", "c_custkey")


@query(f"""
WITH n AS (SELECT quality, count(*) AS n FROM labels GROUP BY 1), f AS (SELECT quality, (SELECT min(n) FROM n) / n AS f FROM n)
SELECT doc_id, quality FROM labels JOIN f USING (quality) WHERE {_DRAW.format(id='doc_id', seed=1)} < f""")
def sample_stratified(spark, sf):
    return S.balance_labels(read(spark, sf, "labels"), "quality", id_col="doc_id", seed=1).select("doc_id", "quality")


@query(f"""
SELECT o_orderkey, CASE WHEN {_DRAW.format(id='o_orderkey', seed=7)} < 0.8 THEN 'train' ELSE 'test' END AS split FROM orders""")
def random_split(spark, sf):
    return S.split_by_hash(read(spark, sf, "orders"), "o_orderkey", {"train": 0.8, "test": 0.2}, seed=7).select("o_orderkey", "split")


@query("SELECT DISTINCT o_custkey, 1 AS tasks FROM orders")
def repartition_by(spark, sf):
    """Rows of one customer meet in one task; counts the tasks each customer is seen in."""
    placed = read(spark, sf, "orders").repartition(8, "o_custkey").withColumn("task", F.spark_partition_id())
    return placed.groupBy("o_custkey").agg(F.count_distinct("task").alias("tasks"))


@query("""
SELECT o_orderstatus, count(*) AS n, (SELECT count(*) FROM orders WHERE o_totalprice > 100000) AS n_all
FROM orders WHERE o_totalprice > 100000 GROUP BY o_orderstatus""")
def cache_reuse(spark, sf):
    reused = read(spark, sf, "orders").where("o_totalprice > 100000").persist()
    try:
        return materialize(reused.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")).withColumn(
            "n_all", reused.agg(F.count(F.lit(1))).scalar()))
    finally:
        reused.unpersist()
