"""A/B tests: clean subjects, sample size, two-proportion z test."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.functions.numbers import normal_cdf
from tallgrass.operators.quality import multi_occurrence


def dedupe_subjects(df: DataFrame, id_col: str) -> DataFrame:
    """Rows of subjects seen exactly once; subjects seen more than once are dropped."""
    return df.join(multi_occurrence(df, [id_col]), id_col, "left_anti")


def ab_sample_size(df: DataFrame, p1: str, p2: str, *, alpha: float = 0.05, power: float = 0.8,
                   name: str = "required_n") -> DataFrame:
    """Subjects needed per arm, by Cohen's effect size; null for equal rates."""
    z = NormalDist().inv_cdf(1 - alpha / 2) + NormalDist().inv_cdf(power)
    effect = 2 * F.asin(F.sqrt(F.col(p1))) - 2 * F.asin(F.sqrt(F.col(p2)))
    return df.withColumn(name, F.ceil(2 * F.pow(F.try_divide(F.lit(z), effect), F.lit(2))).cast("bigint"))


def ab_ztest(df: DataFrame, arm: str, converted: str, *, control: str, treatment: str, alpha: float = 0.05) -> DataFrame:
    """Pooled two-sided z test and a Wald interval per arm, from one aggregation."""

    def arm_sum(value: str, col):
        return F.sum(F.when(F.col(arm) == value, col).otherwise(0)).cast("double")

    sums = df.agg(arm_sum(control, F.lit(1)).alias("n0"), arm_sum(treatment, F.lit(1)).alias("n1"),
                  arm_sum(control, F.col(converted)).alias("x0"), arm_sum(treatment, F.col(converted)).alias("x1"))
    rates = sums.select("*", F.try_divide("x0", "n0").alias("rate_control"), F.try_divide("x1", "n1").alias("rate_treatment"),
                        F.try_divide(F.col("x0") + F.col("x1"), F.col("n0") + F.col("n1")).alias("pooled"))
    pooled = F.col("pooled")
    error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), "n0") + F.try_divide(F.lit(1.0), "n1")))
    tested = rates.withColumn("z", F.try_divide(F.col("rate_control") - F.col("rate_treatment"), error))
    half = NormalDist().inv_cdf(1 - alpha / 2)
    bounds = []
    for side, n in (("control", "n0"), ("treatment", "n1")):
        rate = F.col(f"rate_{side}")
        width = half * F.sqrt(F.try_divide(rate * (1 - rate), n))
        bounds += [F.greatest(rate - width, F.lit(0.0)).alias(f"low_{side}"), F.least(rate + width, F.lit(1.0)).alias(f"high_{side}")]
    return tested.select(
        F.col("n0").cast("bigint").alias("n_control"), F.col("n1").cast("bigint").alias("n_treatment"),
        "rate_control", "rate_treatment", "z", (2 * (1 - normal_cdf(F.abs("z")))).alias("p_value"), *bounds)
