"""Arithmetic expressions that agree with the usual floor conventions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_divide(a: Column, b: Column) -> Column:
    """Quotient rounded down (Spark's ``div`` rounds toward zero)."""
    return F.floor(F.try_divide(a, b))


def floor_mod(a: Column, b: Column) -> Column:
    """Remainder with the sign of the divisor, for a positive divisor."""
    return F.pmod(a, b)


def to_integer(x: Column) -> Column:
    return F.round(x, 0).cast("bigint")


def int_or_null(text: Column) -> Column:
    """Whole number in the text, null for other text.

    Same result as a plain ``try_cast``, which raises and catches an error inside for
    every bad value; text that cannot be a number is set aside first.
    """
    shaped = F.when(text.rlike(r"^\s*[+-]?[0-9]+\s*$"), text)
    return shaped.try_cast("int")


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function by the error-function polynomial

    1 - (a1 t + ... + a5 t^5) exp(-x^2), t = 1 / (1 + p x); absolute error below 1.5e-7.
    """
    # Fixed values (Abramowitz and Stegun 7.1.26).
    p = 0.3275911
    a1, a2, a3, a4, a5 = 0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1.0 / (1.0 + p * x)
    poly = t * (a1 + t * (a2 + t * (a3 + t * (a4 + t * a5))))
    tail = poly * F.exp(-x * x) / 2.0
    return F.when(z >= 0, 1.0 - tail).otherwise(tail)
