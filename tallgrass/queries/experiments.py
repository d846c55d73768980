"""A/B tests and funnels."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from tallgrass.operators.sampling import sample_n
from tallgrass.plans import experiments as X
from tallgrass.plans import funnel as U
from tallgrass.queries import query, read


def sessions(spark, sf):
    """Each line item is a session of its order; the line status is the arm."""
    return read(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("subject"), F.when(F.col("l_linestatus") == "O", "control").otherwise("treatment").alias("arm"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("converted"))


_SESSIONS = """
SELECT l_orderkey AS subject, CASE WHEN l_linestatus = 'O' THEN 'control' ELSE 'treatment' END AS arm,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS converted FROM lineitem"""


@query(f"""
WITH s AS ({_SESSIONS}), once AS (SELECT * FROM s WHERE subject IN (SELECT subject FROM s GROUP BY 1 HAVING count(*) = 1))
SELECT subject, arm, converted FROM (SELECT *, row_number() OVER (PARTITION BY arm ORDER BY md5(subject || ':22'), subject) AS rn FROM once)
WHERE rn <= 100""")
def ab_prepare(spark, sf):
    once = X.dedupe_subjects(sessions(spark, sf), "subject")
    return sample_n(once, ["arm"], 100, id_col="subject", seed=22)


_Z = NormalDist().inv_cdf(0.975) + NormalDist().inv_cdf(0.8)


@query(f"""
WITH r AS (SELECT p_brand, avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0 END) FILTER (l_linestatus = 'O') AS p1,
  avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0 END) FILTER (l_linestatus = 'F') AS p2
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
SELECT p_brand, CASE WHEN p1 <> p2 THEN ceil(2 * ({_Z!r} / (2 * asin(sqrt(p1)) - 2 * asin(sqrt(p2)))) ** 2)::BIGINT END AS required_n FROM r""")
def ab_sample_size(spark, sf):
    rates = (read(spark, sf, "lineitem").groupBy("l_partkey", "l_linestatus")
             .agg(F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("x"), F.count(F.lit(1)).alias("n"))
             .join(read(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand"))

    def rate(status):
        mine = F.col("l_linestatus") == status
        return F.sum(F.when(mine, F.col("x"))) / F.sum(F.when(mine, F.col("n")))

    return X.ab_sample_size(rates.agg(rate("O").alias("p1"), rate("F").alias("p2")), "p1", "p2").select("p_brand", "required_n")


@query(f"""
WITH a AS (SELECT count(*) FILTER (arm = 'control')::DOUBLE n0, count(*) FILTER (arm = 'treatment')::DOUBLE n1,
  sum(converted) FILTER (arm = 'control')::DOUBLE x0, sum(converted) FILTER (arm = 'treatment')::DOUBLE x1 FROM ({_SESSIONS})),
r AS (SELECT *, x0 / n0 AS p0, x1 / n1 AS p1, (x0 + x1) / (n0 + n1) AS p FROM a),
z AS (SELECT *, (p0 - p1) / sqrt(p * (1 - p) * (1 / n0 + 1 / n1)) AS z FROM r),
t AS (SELECT *, abs(z) / sqrt(2.0) AS x, 1 / (1 + 0.3275911 * abs(z) / sqrt(2.0)) AS t FROM z)
SELECT n0::BIGINT AS n_control, n1::BIGINT AS n_treatment, round(p0, 9) AS rate_control, round(p1, 9) AS rate_treatment, round(z, 9) AS z,
  round(t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * exp(-x * x), 9) AS p_value,
  round(greatest(p0 - {NormalDist().inv_cdf(0.975)!r} * sqrt(p0 * (1 - p0) / n0), 0), 9) AS low_control,
  round(least(p0 + {NormalDist().inv_cdf(0.975)!r} * sqrt(p0 * (1 - p0) / n0), 1), 9) AS high_control,
  round(greatest(p1 - {NormalDist().inv_cdf(0.975)!r} * sqrt(p1 * (1 - p1) / n1), 0), 9) AS low_treatment,
  round(least(p1 + {NormalDist().inv_cdf(0.975)!r} * sqrt(p1 * (1 - p1) / n1), 1), 9) AS high_treatment FROM t""")
def ab_ztest(spark, sf):
    out = X.ab_ztest(sessions(spark, sf), "arm", "converted", control="control", treatment="treatment")
    return out.select("n_control", "n_treatment", *[F.round(c, 9).alias(c) for c in out.columns[2:]])


# --- funnel -------------------------------------------------------------------------------

STAGES = {"view": 20.0, "click": 150.0, "signup": 230.0, "purchase": 300.0}


def users(spark, sf):
    """Device and sex are drawn from a digest of the user id."""
    digest = F.md5(F.col("user_id").cast("string"))
    return read(spark, sf, "events").select("user_id").distinct().select(
        "user_id", F.when(F.substring(digest, 1, 1) < "8", "Desktop").otherwise("Mobile").alias("device"),
        F.when(F.substring(digest, 2, 1) < "8", "Male").otherwise("Female").alias("sex"))


def reach(spark, sf):
    hits = {n: (F.col("event_type") == n) & (F.col("value") > low) for n, low in STAGES.items()}
    return U.funnel_reach(users(spark, sf), read(spark, sf, "events"), "user_id", hits)


_REACH = """
SELECT user_id, CASE WHEN substr(md5(user_id::VARCHAR), 1, 1) < '8' THEN 'Desktop' ELSE 'Mobile' END AS device,
  CASE WHEN substr(md5(user_id::VARCHAR), 2, 1) < '8' THEN 'Male' ELSE 'Female' END AS sex, """ + ", ".join(
    f"max(CASE WHEN event_type = '{n}' AND value > {low} THEN 1 ELSE 0 END) AS {n}" for n, low in STAGES.items()) + " FROM events GROUP BY user_id"


@query(_REACH)
def funnel_reach(spark, sf):
    return reach(spark, sf)


@query(" UNION ALL ".join(f"SELECT '{n}' AS stage, sum({n})::BIGINT AS reached FROM ({_REACH})" for n in STAGES))
def funnel_totals(spark, sf):
    return U.stage_totals(reach(spark, sf), list(STAGES))


_MEANS = ", ".join(f"round(avg({n}), 9) AS {n}" for n in STAGES)


@query(f"""
SELECT 'all' AS segment, 'all' AS value, count(*) AS users, {_MEANS} FROM ({_REACH})
UNION ALL SELECT 'device', device, count(*), {_MEANS} FROM ({_REACH}) GROUP BY device
UNION ALL SELECT 'sex', sex, count(*), {_MEANS} FROM ({_REACH}) GROUP BY sex""")
def funnel_conversion(spark, sf):
    out = U.funnel_conversion(reach(spark, sf), list(STAGES), ["device", "sex"])
    return out.select("segment", "value", "users", *[F.round(n, 9).alias(n) for n in STAGES])
