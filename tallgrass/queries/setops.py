"""Set operations."""

from __future__ import annotations

from tallgrass.queries import query, read


def _nations(spark, sf):
    return (read(spark, sf, "customer").where("c_acctbal > 0").selectExpr("c_nationkey AS nationkey"),
            read(spark, sf, "supplier").where("s_acctbal > 4000").selectExpr("s_nationkey AS nationkey"))


_C = "SELECT c_nationkey AS nationkey FROM customer WHERE c_acctbal > 0"
_S = "SELECT s_nationkey AS nationkey FROM supplier WHERE s_acctbal > 4000"


@query(f"{_C} UNION ALL {_S}")
def union_all(spark, sf):
    a, b = _nations(spark, sf)
    return a.union(b)


@query(f"{_C} UNION {_S}")
def union_distinct(spark, sf):
    a, b = _nations(spark, sf)
    return a.union(b).distinct()


@query("""
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""")
def union_by_name(spark, sf):
    customer = read(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_mktsegment AS segment")
    supplier = read(spark, sf, "supplier").selectExpr("s_name AS name", "s_suppkey AS id")
    return customer.unionByName(supplier, allowMissingColumns=True)


@query(f"{_C} INTERSECT {_S}")
def intersect(spark, sf):
    a, b = _nations(spark, sf)
    return a.intersect(b)
