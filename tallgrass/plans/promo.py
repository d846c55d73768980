"""Promotion load: checks, one projection, Parquet sink, outcome record."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.functions.conditions import flag, safe_divide
from tallgrass.functions.dates import iso_week_start
from tallgrass.operators import quality as Q
from tallgrass.operators.columns import rename_symbols
from tallgrass.session import materialize

# Symbol replacements, measured columns and limits of the promotion files.
SYMBOLS = {" ": "_", "?": "", "$": "dollars", "#": "num"}
MEASURES = ["Price", "Discount", "Units", "Sales $", "Gross Margin $", "# Transactions that contained the product"]
YEARS, WEEKS, TOLERANCE = (2000, 2030), (1, 53), 0.01

MONEY, MARGIN, RATE = "decimal(18,2)", "decimal(18,4)", "decimal(9,4)"


def promo_rules(df: DataFrame) -> list[Q.Rule]:
    return [
        *Q.non_negative(df, MEASURES),
        Q.within("Discount", 0, 1, "discount_range"),
        Q.in_domain("On Flyer?", ["Yes", "No"], "on_flyer"),
        Q.within("Year", *YEARS, "year_range"),
        Q.within("week number", *WEEKS, "week_range"),
        Q.close_to("Sales $", lambda: F.col("Units") * F.col("Price") * (1 - F.col("Discount")), TOLERANCE, "sales_consistency"),
    ]


def promo_report(df: DataFrame, label: str = "input") -> DataFrame:
    """Rule violations and missing values per column and input, with the input's row count, from one pass.

    ``label`` is the column that names the input of a row. An input without rows has none here.
    """
    data = df.drop(label)
    return Q.check_rules(df, [*promo_rules(data), *Q.not_missing(data)], by=[label])


def promo_transform(df: DataFrame, *extra: str) -> DataFrame:
    """Published columns; price, margin and their rounding are exact decimals.

    ``extra`` names further input columns to carry along.
    """
    clean = rename_symbols(df, SYMBOLS)
    price, off, units = F.col("Price").cast(MONEY), F.col("Discount").cast(RATE), F.col("Units")
    margin, sales = F.col("Gross_Margin_dollars").cast(MARGIN), F.col("Sales_dollars").cast(MONEY)
    category = F.when(units >= 100, "High").when(units >= 50, "Medium").otherwise("Low")
    return clean.select(
        *extra, "Year", "week_number", F.upper(F.trim("Product")).alias("Product"), price.alias("Price"), off.alias("Discount"),
        F.round(off * 100, 2).alias("Discount_Percent"), F.round(price * (1 - off), 2).alias("Final_Unit_Price"),
        "Units", sales.alias("Sales_dollars"), margin.alias("Gross_Margin_dollars"),
        F.round(safe_divide(margin * 100, sales), 2).alias("Gross_Margin_Percent"),
        flag(F.col("On_Flyer") == "Yes").alias("On_Flyer_Flag"), flag(off > 0.5).alias("High_Discount_Flag"),
        category.alias("Sales_Category"), iso_week_start(F.col("Year"), F.col("week_number")).alias("Week_Start_Date"))


def labelled(**inputs: DataFrame) -> DataFrame:
    """Inputs under one another, each row named by its input."""
    return reduce(DataFrame.unionByName, [df.withColumn("input", F.lit(name)) for name, df in inputs.items()])


def promo_load(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Transformed rows of both inputs, and the rule report of both."""
    both = labelled(old=old, new=new)
    return promo_transform(both), promo_report(both)


def promo_pipeline(df: DataFrame, path: str, *, label: str = "input", allow_errors: bool = False) -> DataFrame:
    """Check the labelled inputs, write them as Parquet, and return one outcome row per input.

    The report is one pass. If any input breaks a rule of severity ``error`` nothing is written,
    unless ``allow_errors`` says otherwise; warnings never refuse. The write replaces ``path`` as
    a whole, so a repeated load leaves one copy. Outcome: rows, violations by severity, status.
    """
    df = df.persist()  # the input may be a join; both passes read its rows from here

    def broken(severity: str) -> Column:
        return F.sum(F.when(F.col("severity") == severity, F.col("violations")).otherwise(0))

    try:
        outcome = materialize(promo_report(df, label).groupBy(label).agg(
            F.max("n").alias("n_rows"), broken("error").alias("errors"), broken("warning").alias("warnings")))
        refused = not allow_errors and not outcome.where("errors > 0").isEmpty()
        if not refused:
            promo_transform(df, label).write.mode("overwrite").parquet(path)
    finally:
        df.unpersist()
    return outcome.withColumn("status", F.lit("refused" if refused else "written"))
