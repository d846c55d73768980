"""Business measures over a star of facts and dimensions.

A star is a fact frame and a map of relationships; a measure groups the joined fact
by any of its columns. Facts are folded by their dimension key before the join, so the
join moves one row per key, not one per fact row, and a hot key costs no more than any
other.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.functions.conditions import flag
from tallgrass.functions.dates import month_floor, month_number
from tallgrass.operators.aggregates import beside_average, share_of_total
from tallgrass.operators.joins import join_star

_DAY_ZERO = "1970-01-01"


@dataclass
class Star:
    """Fact with ``(dim, fact_key, dim_key, how)`` relationships by dimension name."""

    fact: DataFrame
    dims: dict[str, tuple[DataFrame, str, str, str]] = field(default_factory=dict)

    def joined(self, *names: str) -> DataFrame:
        return join_star(self.fact, [self.dims[n] for n in names])


@dataclass(frozen=True)
class Measure:
    """``parts`` are row values of the fact that are summed; ``value`` combines the
    sums and dimension columns over the joined rows. ``keep`` names columns that must
    survive the fold, such as one to be counted distinct."""

    parts: dict[str, Callable[[], Column]]
    value: Callable[[], Column]
    keep: tuple[str, ...] = ()


def _one() -> Column:
    return F.lit(1)


def _quantity() -> Column:
    return F.col("quantity")


def _sales() -> Column:
    return F.col("sales")


def _day(name: str) -> Column:
    return F.datediff(F.col(name), F.lit(_DAY_ZERO).cast("date"))


def _ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b)


def _cost() -> Column:
    return F.sum(F.col("_quantity") * F.col("cost_each"))


MEASURES: dict[str, Measure] = {
    "sales": Measure({"_sales": _sales}, lambda: F.sum("_sales")),
    "cost": Measure({"_quantity": _quantity}, _cost),
    "profit": Measure({"_sales": _sales, "_quantity": _quantity}, lambda: F.sum("_sales") - _cost()),
    "quantity": Measure({"_quantity": _quantity}, lambda: F.sum("_quantity")),
    "rows": Measure({"_rows": _one}, lambda: F.sum("_rows")),
    "customers": Measure({}, lambda: F.count_distinct("customer_id"), ("customer_id",)),
    "return_rate": Measure({"_back": lambda: flag(F.col("quantity") < 0), "_rows": _one},
                           lambda: _ratio(F.sum("_back"), F.sum("_rows"))),
    "loyalty_index": Measure({"_many": lambda: flag(F.col("quantity") > 1)},
                             lambda: _ratio(F.sum("_many"), F.count_distinct("customer_id")), ("customer_id",)),
    "inventory_turnover": Measure({"_sales": _sales, "_quantity": _quantity, "_rows": _one},
                                  lambda: _ratio(F.sum("_sales"), _ratio(_cost(), F.sum("_rows")))),
    "days_to_ship": Measure({"_ship": lambda: _day("ship_date"), "_rows": lambda: flag(F.col("ship_date").isNotNull())},
                            lambda: _ratio(F.sum("_ship") - F.sum(F.col("_rows") * _day("order_date")), F.sum("_rows"))),
}


def measure(names: list[str], star: Star, dims: list[str], *, via: list[str] = ()) -> DataFrame:
    """Named measures grouped by columns of the fact and the ``via`` dimensions.

    The fact is folded before the joins if that leaves one key, or none; by several
    keys together hardly any rows would fall into one.
    """
    chosen = [MEASURES[n] for n in names]
    parts = {part: build for m in chosen for part, build in m.parts.items()}
    wanted = [star.dims[v][1] for v in via] + list(dims) + [k for m in chosen for k in m.keep]
    keys = [k for k in dict.fromkeys(wanted) if k in star.fact.columns]
    if len(keys) <= 1:
        rows = star.fact.groupBy(*keys).agg(*[F.sum(build()).alias(part) for part, build in (parts or {"_rows": _one}).items()])
    else:
        rows = star.fact.select(*keys, *[build().alias(part) for part, build in parts.items()])
    joined = Star(rows, star.dims).joined(*via)
    return joined.groupBy(*dims).agg(*[m.value().alias(n) for n, m in zip(names, chosen, strict=True)])


def totals(fact: DataFrame, key: str, value: str, name: str) -> DataFrame:
    return fact.groupBy(key).agg(F.sum(value).alias(name))


def top_with_ties(per_key: DataFrame, value: str, n: int) -> DataFrame:
    """Rows among the ``n`` largest values, ties with the last one kept."""
    edge = per_key.orderBy(F.desc(value)).limit(n).agg(F.min(value)).scalar()
    return per_key.where(F.col(value) >= edge)


def top_share(per_key: DataFrame, value: str, n: int) -> DataFrame:
    """Share of the total held by the top ``n`` with ties."""
    whole = per_key.agg(F.sum(value)).scalar()
    return top_with_ties(per_key, value, n).agg(F.sum(value).alias("top"), F.count(F.lit(1)).alias("members")).withColumn(
        "share", F.try_divide(F.col("top").cast("double"), whole))


def monthly(fact: DataFrame, ts: str, value: str) -> DataFrame:
    return fact.groupBy(month_floor(F.col(ts)).alias("month")).agg(F.sum(value).alias("sales"))


def yoy_variance(months: DataFrame) -> DataFrame:
    """Each month against the same month a year before; null where there is none.

    The frame is one row per month, matched by month number, so gaps do not shift it.
    """
    year_before = Window.orderBy(month_number(F.col("month"))).rangeBetween(-12, -12)
    out = months.withColumn("last_year", F.sum("sales").over(year_before))
    return out.withColumn("variance", F.col("sales") - F.col("last_year"))


def new_customers(fact: DataFrame, customer: str, ts: str, year: int) -> DataFrame:
    """Customers whose first purchase falls in the year, and those with exactly one row in it."""
    per = fact.groupBy(customer).agg(F.min(F.year(ts)).alias("_first"), F.count_if(F.year(ts) == year).alias("_n"))
    return per.agg(F.count_if(F.col("_first") == year).alias("first_purchase"), F.count_if(F.col("_n") == 1).alias("single_row"))


def months_above_average(months: DataFrame) -> DataFrame:
    marked = beside_average(months, "sales", "average")
    return marked.agg(F.count_if(F.col("sales") > F.col("average")).alias("months_above"), F.count(F.lit(1)).alias("months"))


def quarterly_growth(fact: DataFrame, ts: str, value: str) -> DataFrame:
    """Sales per quarter and the growth against the quarter before; one row per quarter."""
    quarters = fact.groupBy(F.to_date(F.date_trunc("quarter", ts)).alias("quarter")).agg(F.sum(value).alias("sales"))
    before = F.lag("sales").over(Window.orderBy("quarter"))
    return quarters.withColumn("growth", F.try_divide((F.col("sales") - before).cast("double"), before))


def price_bands(fact: DataFrame, price: str, limit: float, values: list[str]) -> DataFrame:
    """Averages of High and Low priced rows."""
    band = F.when(F.col(price) > limit, "High").otherwise("Low")
    return fact.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"), *[F.avg(v).alias(v) for v in values])


def with_share(per_key: DataFrame, value: str) -> DataFrame:
    return share_of_total(per_key, value, "share")
