"""Null handling and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.operators import quality as Q
from tallgrass.queries import query, read

_LABELLED = "(SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))"


def labelled(spark, sf):
    return read(spark, sf, "documents").select("doc_id", "lang").join(read(spark, sf, "labels"), "doc_id", "left")


@query(f"SELECT doc_id, lang, quality, toxic FROM {_LABELLED} WHERE quality IS NOT NULL AND toxic IS NOT NULL")
def na_drop(spark, sf):
    df = labelled(spark, sf)
    both = Q.na_drop(df, how="any", subset=["quality", "toxic"])
    return Q.na_drop(both, how="all").select("doc_id", "lang", "quality", "toxic")


@query(f"SELECT doc_id, lang, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic FROM {_LABELLED}")
def na_fill(spark, sf):
    return Q.na_fill(labelled(spark, sf), 0, ["lang", "quality", "toxic"]).select("doc_id", "lang", "quality", "toxic")


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def na_replace(spark, sf):
    return Q.na_replace(read(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), {"F": "done", "O": "open"}, ["o_orderstatus"])


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing FROM {_LABELLED}"
                          for c in ("doc_id", "lang", "quality", "toxic")))
def na_count_by_column(spark, sf):
    return Q.missing_by_column(labelled(spark, sf).select("doc_id", "lang", "quality", "toxic"))


@query("""
SELECT 'non_negative' AS rule, 'l_quantity' AS "column", 'error' AS severity, count(*) FILTER (l_quantity < 0) AS violations FROM lineitem
UNION ALL SELECT 'non_negative', 'l_tax', 'error', count(*) FILTER (l_tax < 0) FROM lineitem
UNION ALL SELECT 'discount_range', 'l_discount', 'error', count(*) FILTER (l_discount < 0.02 OR l_discount > 0.08) FROM lineitem
UNION ALL SELECT 'domain', 'l_returnflag', 'error', count(*) FILTER (l_returnflag NOT IN ('A', 'N')) FROM lineitem
UNION ALL SELECT 'sales', 'l_extendedprice', 'warning', count(*) FILTER (abs(l_extendedprice - l_quantity * 2000) > 10000) FROM lineitem""")
def dq_rules(spark, sf):
    lineitem = read(spark, sf, "lineitem")
    rules = [*Q.non_negative(lineitem, ["l_quantity", "l_tax", "absent"]),
             Q.within("l_discount", 0.02, 0.08, "discount_range"), Q.in_domain("l_returnflag", ["A", "N"]),
             Q.close_to("l_extendedprice", lambda: F.col("l_quantity") * 2000, 10_000, "sales")]
    return Q.check_rules(lineitem, rules)


@query(f"""
SELECT 'accepted' AS outcome, count(*) AS n FROM {_LABELLED} WHERE quality IS NOT NULL
UNION ALL SELECT 'rejected', count(*) FROM {_LABELLED} WHERE quality IS NULL""")
def dq_not_null_enforce(spark, sf):
    accepted, rejected = Q.split_not_null(labelled(spark, sf), ["doc_id", "quality"])
    return accepted.agg(F.lit("accepted").alias("outcome"), F.count(F.lit(1)).alias("n")).unionByName(
        rejected.agg(F.lit("rejected").alias("outcome"), F.count(F.lit(1)).alias("n")))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dq_multi_occurrence(spark, sf):
    return Q.multi_occurrence(read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
