"""Aggregations, subtotals, pivots and profiles."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.operators.columns import quoted


def profile(df: DataFrame, col: str, order: list[str]) -> DataFrame:
    """One row of summary figures; first and last follow the stated order.

    First and last are top-one reads beside the aggregate, which keeps the aggregate
    on fixed-width buffers.
    """
    x = F.col(col)
    first = df.orderBy(*[F.col(c).asc() for c in order]).limit(1).select(col).scalar()
    last = df.orderBy(*[F.col(c).desc() for c in order]).limit(1).select(col).scalar()
    figures = df.agg(
        F.count(x).alias("n"), F.count_distinct(x).alias("n_distinct"), F.sum_distinct(x).alias("sum_distinct"),
        F.min(x).alias("min"), F.max(x).alias("max"), F.sum(x).alias("sum"), F.avg(x).alias("mean"),
        F.var_samp(x).alias("var_samp"), F.var_pop(x).alias("var_pop"), F.stddev_samp(x).alias("stddev_samp"),
        F.stddev_pop(x).alias("stddev_pop"), F.kurtosis(x).alias("kurtosis"), F.skewness(x).alias("skewness"))
    return figures.select("*", first.alias("first"), last.alias("last"))


def standard_error(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Mean, population deviation and its standard error per group."""
    x = F.col(col)
    return df.groupBy(*keys).agg(
        F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"),
        (F.stddev_pop(x) / F.sqrt(F.count(x))).alias("stderr"))


def percent_of_group(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """Counts of each value and their share of the group in percent."""
    counts = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(*group).agg(F.sum("n").alias("_all"))
    joined = counts.join(totals, group) if group else counts.withColumn("_all", totals.scalar())
    return joined.withColumn("percent", F.col("n") * 100.0 / F.col("_all")).drop("_all")


def subtotals(df: DataFrame, dims: list[str], aggs: list[Column], *, kind: str = "rollup",
              levels: list[int] | None = None) -> DataFrame:
    """Rollup or cube with the grouping level; ``levels`` keeps only some of them."""
    grouped = df.rollup(*dims) if kind == "rollup" else df.cube(*dims)
    out = grouped.agg(*aggs, F.grouping_id().alias("level"))
    return out.where(F.col("level").isin(levels)) if levels is not None else out


def pivot_sum(df: DataFrame, rows: list[str], col: str, value: str, *, values: list, total: bool = False) -> DataFrame:
    """Sum of ``value`` with one column per entry of ``values``.

    The columns are stated by the caller, so no extra pass looks for them. With
    ``total`` a last row named Total sums the first row key over all rows.
    """
    cells = [F.sum(F.when(F.col(col) == v, F.col(value))).alias(str(v)) for v in values]
    if not total:
        return df.groupBy(*rows).agg(*cells)
    out = df.rollup(*rows).agg(*cells, F.grouping_id().alias("_g"))
    everything = 2 ** len(rows) - 1
    out = out.where(F.col("_g").isin(0, everything))
    first = F.when(F.col("_g") == everything, "Total").otherwise(F.col(rows[0]).cast("string"))
    return out.withColumn(rows[0], first).drop("_g")


def crosstab(df: DataFrame, row: str, col: str, *, values: list | None = None) -> DataFrame:
    """Counts with one column per value; stays distributed in the rows.

    Without ``values`` the columns are all values in the data (``spark.sql.pivotMaxValues`` at
    most, more is an error); with them, values not stated are left out.
    """
    if values is None:
        return df.groupBy(row).pivot(col).agg(F.count(F.lit(1))).na.fill(0)
    return df.groupBy(row).agg(*[F.count_if(F.col(col) == v).alias(str(v)) for v in values])


def value_counts(df: DataFrame, col: str, top: int | None = None) -> DataFrame:
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), col)
    return counts.limit(top) if top else counts


def key_profile(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per distinct key, its inverse, and whether the columns identify a row."""
    n, d = F.col("n_rows"), F.col("n_distinct")
    distinct = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    out = distinct.agg(F.sum("_c").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"))
    return out.select(F.lit(",".join(keys)).alias("keys"), "n_rows", "n_distinct",
                      (n / d).alias("cardinality"), (d / n).alias("entropy"), (n == d).alias("is_key"))


def unpivot_measures(df: DataFrame, ids: list[str], measures: list[str], name: str = "measure",
                     value: str = "value") -> DataFrame:
    return df.unpivot([quoted(c) for c in ids], [quoted(c) for c in measures], name, value)


def label_of_max(df: DataFrame, keys: list[str], label: str, value: str) -> DataFrame:
    """Label of the row with the largest value; equal values resolve to the smallest label."""
    best = df.groupBy(*keys, label).agg(F.max(value).alias("_v"))
    top = best.groupBy(*keys).agg(F.max("_v").alias(value))
    rows = best.join(top, keys) if keys else best.withColumn(value, top.scalar())
    return rows.where(F.col("_v") == F.col(value)).groupBy(*keys).agg(F.min(label).alias(label), F.max(value).alias(value))


def signed_ledger(df: DataFrame, keys: list[str], kind: str, amount: str, *, plus: list, minus: list) -> DataFrame:
    """Balance per key: amounts of the ``plus`` kinds less those of the ``minus`` kinds."""
    signed = F.when(F.col(kind).isin(plus), F.col(amount)).when(F.col(kind).isin(minus), -F.col(amount))
    return df.groupBy(*keys).agg(F.sum(signed).alias("balance"))


def _corr(a: str, b: str) -> Column:
    """Correlation over the rows that have both; null, not an error, where one is constant."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(F.when(both, F.col(a))) * F.stddev_pop(F.when(both, F.col(b))))


def correlation_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """Correlation of every pair of numeric columns: a, b, corr, one row per ordered pair.

    Columns without a null go through one Gram matrix of centred vectors, which tasks add up
    in a tree: k² numbers a task, whatever the rows. A pair with a nullable column is taken
    over the rows that have both, by an aggregate of its own. Null where a column is constant
    or fewer than two rows have both. Only the k² results reach the driver.
    """
    doubles = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    names = doubles.columns
    rows, *seen = doubles.agg(F.count(F.lit(1)), *[F.struct(F.count(x), F.min(x) == F.max(x)) for x in names]).first()
    whole = [i for i, (n, same) in enumerate(seen) if n == rows and same is False]
    found = {(i, j): None for i, (_, same) in enumerate(seen) if same is not False for j in range(len(cols))}
    found |= {(j, i): None for i, j in found}
    if whole:
        vectors = VectorAssembler(inputCols=[names[i] for i in whole], outputCol="v").transform(doubles).select("v")
        matrix = Correlation.corr(vectors, "v").first()[0].toArray()
        found |= {(i, j): float(matrix[p][q]) for p, i in enumerate(whole) for q, j in enumerate(whole)}
    rest = [(i, j) for i in range(len(cols)) for j in range(i, len(cols)) if (i, j) not in found]
    for at in range(0, len(rest), 20):  # few aggregates at a time, so that their code is compiled
        part = rest[at:at + 20]
        values = doubles.agg(*[_corr(names[i], names[j]).alias(f"c{n}") for n, (i, j) in enumerate(part)]).first()
        found |= {(i, j): v for (i, j), v in zip(part, values)}
    out = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            value = found[(i, j) if (i, j) in found else (j, i)]
            out.append((a, b, None if value is None or math.isnan(value) else float(value)))
    return df.sparkSession.createDataFrame(out, "a string, b string, corr double")


def sum_of(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def share_of_total(df: DataFrame, value: str, name: str) -> DataFrame:
    """Share of the column total; the total is a scalar, not a one-task window."""
    return df.withColumn(name, F.col(value) / df.agg(F.sum(value)).scalar())


def beside_average(df: DataFrame, value: str, name: str) -> DataFrame:
    return df.withColumn(name, df.agg(F.avg(value)).scalar())


def previous_row(df: DataFrame, keys: list[str], order: str, value: str, name: str) -> DataFrame:
    """Value of the row before within the key, for frames already at a calendar grain."""
    return df.withColumn(name, F.lag(value).over(Window.partitionBy(*keys).orderBy(order)))
