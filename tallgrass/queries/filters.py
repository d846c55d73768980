"""Filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.functions import conditions as cond
from tallgrass.operators import filters as P
from tallgrass.queries import query, read


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000")
def filter_basic(spark, sf):
    return read(spark, sf, "orders").where("o_totalprice > 300000").select("o_orderkey", "o_totalprice")


@query("""SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
WHERE (l_quantity < 10 OR l_discount > 0.05) AND NOT (l_returnflag = 'A') AND l_linestatus = 'O'""")
def filter_compound(spark, sf):
    small = F.col("l_quantity") < 10
    cheap = F.col("l_discount") > 0.05
    return (read(spark, sf, "lineitem").where((small | cheap) & ~(F.col("l_returnflag") == "A"))
            .where(F.col("l_linestatus") == "O")
            .select("l_orderkey", "l_linenumber", "l_quantity", "l_discount"))


@query("""SELECT c_custkey, c_mktsegment FROM customer
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey NOT IN (1, 2, 3)""")
def filter_in(spark, sf):
    return (read(spark, sf, "customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
            .where(~F.col("c_nationkey").isin(1, 2, 3)).select("c_custkey", "c_mktsegment"))


@query("SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount BETWEEN 0.05 AND 0.07")
def filter_between(spark, sf):
    return (read(spark, sf, "lineitem").where(F.col("l_discount").between(0.05, 0.07))
            .select("l_orderkey", "l_linenumber", "l_discount"))


@query("""
SELECT d.doc_id, d.lang, CASE WHEN l.doc_id IS NULL THEN 'unlabelled' ELSE 'labelled' END AS state
FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.quality IS NULL OR l.toxic IS NOT NULL""")
def filter_null(spark, sf):
    docs, labels = read(spark, sf, "documents").select("doc_id", "lang"), read(spark, sf, "labels")
    joined = docs.join(labels, "doc_id", "left")
    return joined.where(F.col("quality").isNull() | F.col("toxic").isNotNull()).select(
        "doc_id", "lang", F.when(F.col("quality").isNull() & F.col("toxic").isNull(), "unlabelled")
        .otherwise("labelled").alias("state"))


@query("""SELECT p_partkey, p_name FROM part
WHERE p_name LIKE '%ring%' OR p_name LIKE 'small%' OR p_name LIKE '%bolt' OR instr(p_name, 'red') >= 1
   OR substr(p_name, 1, 3) = 'lar'""")
def filter_text(spark, sf):
    name = F.col("p_name")
    return read(spark, sf, "part").where(
        name.like("%ring%") | name.startswith("small") | name.endswith("bolt") | (F.instr(name, "red") >= 1)
        | (name.substr(1, 3) == "lar")).select("p_partkey", "p_name")


@query("""
WITH w AS (SELECT c_custkey, c_mktsegment[1:1] || lower(c_mktsegment[2:4]) || '$' || c_nationkey || replace(c_name[10:13], '#', '') AS word FROM customer)
SELECT c_custkey, word, (length(word) BETWEEN 6 AND 12 AND regexp_matches(word, '[a-z]') AND regexp_matches(word, '[0-9]')
  AND regexp_matches(word, '[A-Z]') AND regexp_matches(word, '[$#@]') AND NOT regexp_matches(word, '\\s')) AS valid FROM w""")
def filter_regex_rules(spark, sf):
    segment, name = F.col("c_mktsegment"), F.col("c_name")
    word = F.concat(segment.substr(1, 1), F.lower(segment.substr(2, 3)), F.lit("$"), "c_nationkey",
                    F.replace(name.substr(10, 4), F.lit("#"), F.lit("")))
    return read(spark, sf, "customer").select("c_custkey", word.alias("word")).withColumn(
        "valid", P.matches_all(F.col("word"), P.PASSWORD_RULES))


@query("""
SELECT CASE WHEN o_totalprice BETWEEN 0 AND 50000 THEN 'low' WHEN o_totalprice BETWEEN 50000 AND 250000 THEN 'middle'
            ELSE 'high' END AS price_range, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS finished, count(*) AS n
FROM orders GROUP BY ALL""")
def case_when(spark, sf):
    price = F.col("o_totalprice")
    label = F.when(price.between(0, 50000), "low").when(price.between(50000, 250000), "middle").otherwise("high")
    return (read(spark, sf, "orders").groupBy(label.alias("price_range"), cond.flag(F.col("o_orderstatus") == "F").alias("finished"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("""
SELECT l_orderkey, l_linenumber, l_suppkey, round(l_tax / nullif(l_discount, 0), 6) AS tax_per_discount FROM lineitem""")
def null_if_guard(spark, sf):
    return read(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        F.round(cond.safe_divide(F.col("l_tax"), F.col("l_discount")), 6).alias("tax_per_discount"))


@query("""SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_orderstatus IN ('F', 'P') AND o_orderpriority IN ('1-URGENT', '5-LOW')""")
def param_filter(spark, sf):
    chosen = {"o_orderstatus": ["F", "P"], "o_orderpriority": ["1-URGENT", "5-LOW"], "o_custkey": []}
    return P.apply_param_filters(read(spark, sf, "orders"), chosen).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("""SELECT p_partkey, 'https://example.org/search?q=' || replace(replace(p_name, '#', '%23'), ' ', '+') AS link FROM part""")
def url_lookup_col(spark, sf):
    return read(spark, sf, "part").select(
        "p_partkey", cond.lookup_link("https://example.org/search?q=", F.col("p_name")).alias("link"))
