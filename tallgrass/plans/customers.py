"""Customer analytics: monthly sales, cohorts, RFM scores, tenure, segments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.functions.dates import month_floor, months_apart
from tallgrass.operators.ordered import exact_quantiles
from tallgrass.plans.clusters import kmeans, nearest_centre
from tallgrass.session import materialize

# Lowest score of each level.
RFM_LEVELS = {"Platinum Plus": 14, "Platinum": 11, "Gold": 8, "Silver": 6}
RFM_LOWEST = "Bronze"


def monthly_sales(df: DataFrame, ts: str, amount: str) -> DataFrame:
    return df.groupBy(month_floor(F.col(ts)).alias("month")).agg(F.sum(amount).alias("sales"))


def cohort_months(df: DataFrame, customer: str, ts: str) -> DataFrame:
    """Active months per customer with cohort month and 1-based index.

    Rows are cut down to one per customer and month before the window, so a customer
    never brings more rows into a task than the calendar has months.
    """
    active = df.select(F.col(customer).alias("customer"), month_floor(F.col(ts)).alias("month")).distinct()
    cohort = F.min("month").over(Window.partitionBy("customer"))
    months = active.withColumn("cohort", cohort)
    return months.withColumn("index", months_apart(F.col("month"), F.col("cohort")) + 1)


def cohort_counts(df: DataFrame, customer: str, ts: str) -> DataFrame:
    return cohort_months(df, customer, ts).groupBy("cohort", "index").agg(F.count("customer").alias("customers"))


def cohort_retention(df: DataFrame, customer: str, ts: str) -> DataFrame:
    """Customers of each cohort still active, in percent of its first month."""
    counts = cohort_counts(df, customer, ts)
    size = F.max(F.when(F.col("index") == 1, F.col("customers"))).over(Window.partitionBy("cohort"))
    return counts.withColumn("retention", F.round(F.col("customers") * 100.0 / size, 2))


def cohort_matrix(df: DataFrame, customer: str, ts: str, indexes: list[int] | None = None, *, least: int = 0) -> DataFrame:
    """Counts with one column per cohort index; without ``indexes`` one for each in the data, and for 1 to ``least`` in any case.

    Then customers with purchases of no date are counted in a column ``undated``, if the data have any.
    With ``indexes``, fails when the data hold an index that isn't among ``indexes``.
    """
    counts = cohort_counts(df, customer, ts)
    if indexes is None:
        counts = materialize(counts)  # at most a row per two months; its indexes name the columns
        known = {r[0] for r in counts.select("index").distinct().collect()}
        indexes = sorted((known - {None}) | {*range(1, least + 1)})
        undated = [F.max(F.when(F.col("index").isNull(), F.col("customers"))).alias("undated")] if None in known else []
    else:
        undated = []
        missing = F.raise_error(F.concat(F.lit("no column for cohort index "), F.col("index").cast("string"))).cast("int")
        counts = counts.withColumn("index", F.when(F.col("index").isin(list(indexes)), F.col("index")).otherwise(missing))
    return counts.groupBy("cohort").agg(
        *[F.max(F.when(F.col("index") == i, F.col("customers"))).alias(f"m{i}") for i in indexes], *undated)


def rfm_base(df: DataFrame, customer: str, ts: str, amount: str, *, as_of: str | None = None) -> DataFrame:
    """Days since the last purchase, rows, money; counted to the day after ``as_of``,
    by default the last day in the data."""
    last_day = F.lit(as_of).cast("date") if as_of else df.agg(F.max(F.to_date(ts))).scalar()
    per = df.groupBy(F.col(customer).alias("customer")).agg(
        F.max(F.to_date(ts)).alias("_last"), F.count(F.lit(1)).alias("frequency"), F.sum(amount).alias("monetary"))
    return per.select("customer", F.datediff(F.date_add(last_day, 1), F.col("_last")).alias("recency"), "frequency", "monetary")


def quantile_bins(df: DataFrame, bins: dict[str, tuple[str, bool]], q: int) -> DataFrame:
    """Bins 1..q by exact quantile edges, right-closed; equal values share a bin.

    ``bins`` maps a column to the name of its bin and whether the count runs down from
    ``q``. The edges of all columns come from one ranking of (column, value) rows.
    Edges that coincide merge their bins, so a bin number may stay unused.
    """
    names = [f"e{i}" for i in range(1, q)]
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in bins])).alias("r")).select("r.*")
    edges = exact_quantiles(long, ["measure"], "value", {n: i / q for i, n in enumerate(names, 1)})
    one_row = edges.agg(F.map_from_entries(F.collect_list(F.struct("measure", F.struct(*names)))).alias("m"))
    out = df.withColumn("_edges", one_row.scalar())
    for c, (name, reverse) in bins.items():
        above = sum(F.when(F.col(c).cast("double") > F.col("_edges")[c][n], 1).otherwise(0) for n in names)
        out = out.withColumn(name, F.lit(q) - above if reverse else above + 1)
    return out.drop("_edges")


def rfm_scores(base: DataFrame, q: int = 5) -> DataFrame:
    """Quintile scores, recent customers scoring high, and their sum.

    The base is written once, as the ranking and the scoring both read it.
    """
    df = quantile_bins(materialize(base), {"recency": ("r", True), "frequency": ("f", False), "monetary": ("m", False)}, q)
    return df.withColumn("score", F.col("r") + F.col("f") + F.col("m"))


def with_level(scores: DataFrame) -> DataFrame:
    level = None
    for name, low in RFM_LEVELS.items():
        level = F.when(F.col("score") >= low, name) if level is None else level.when(F.col("score") >= low, name)
    return scores.withColumn("level", level.otherwise(RFM_LOWEST))


def rfm_levels(scores: DataFrame) -> DataFrame:
    """Mean figures and size of each level, to one digit."""
    return with_level(scores).groupBy("level").agg(
        F.round(F.avg("recency"), 1).alias("recency"), F.round(F.avg("frequency"), 1).alias("frequency"),
        F.round(F.avg("monetary"), 1).alias("monetary"), F.count(F.lit(1)).alias("customers"))


def log_zscore(df: DataFrame, cols: list[str], *, shift: list[str] = ()) -> DataFrame:
    """Natural log, then centred and scaled with the population deviation.

    Columns in ``shift`` are first moved up by the absolute minimum plus one.
    """
    ready = df
    for c in shift:
        low = df.agg(F.min(c)).scalar()
        ready = ready.withColumn(c, F.col(c) + F.abs(low) + 1)
    logged = ready.select(*[c for c in df.columns if c not in cols], *[F.ln(F.col(c).cast("double")).alias(c) for c in cols])
    stats = logged.agg(F.struct(*[F.struct(F.avg(c).alias("mu"), F.stddev_pop(c).alias("sd")).alias(c) for c in cols]).alias("s"))
    s = stats.scalar()
    scaled = [F.try_divide(F.col(c) - s[c]["mu"], s[c]["sd"]).alias(c) for c in cols]
    return logged.select(*[c for c in df.columns if c not in cols], *scaled)


def customer_tenure(df: DataFrame, customer: str, ts: str) -> DataFrame:
    """Days from the first purchase to the last date in the data, both included."""
    last_day = df.agg(F.max(F.to_date(ts))).scalar()
    first = df.groupBy(F.col(customer).alias("customer")).agg(F.min(F.to_date(ts)).alias("first_day"))
    return first.withColumn("tenure", F.datediff(last_day, F.col("first_day")) + 1)


def kmeans_segments(df: DataFrame, cols: list[str], k: int, *, id_col: str, seed: int = 1) -> DataFrame:
    """Cluster number per row; null for rows with a null coordinate. The same clusters for any layout of the rows."""
    centres, _ = kmeans(df, id_col, cols, [k], seed=seed)[k]
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return df.withColumn("cluster", F.when(known, nearest_centre(cols, centres)) if len(centres) else F.lit(None).cast("int"))


def cluster_profile(df: DataFrame, cluster: str, cols: list[str]) -> DataFrame:
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("members"), *[F.avg(c).alias(c) for c in cols])


def kmeans_elbow(df: DataFrame, cols: list[str], ks, *, id_col: str, seed: int = 1) -> DataFrame:
    """Within-cluster sum of squares for each number of clusters, from one start and shared passes."""
    rows = [(k, sse) for k, (_, sse) in sorted(kmeans(df, id_col, cols, ks, seed=seed).items())]
    return df.sparkSession.createDataFrame(rows, "k int, sse double")


def relative_importance(df: DataFrame, cluster: str, cols: list[str]) -> DataFrame:
    """Cluster mean over population mean, less one."""
    whole = df.agg(F.struct(*[F.avg(c).alias(c) for c in cols])).scalar()
    means = df.groupBy(cluster).agg(*[F.avg(c).alias(c) for c in cols])
    return means.select(cluster, *[(F.try_divide(F.col(c), whole[c]) - 1).alias(c) for c in cols])
