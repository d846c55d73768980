"""Time series keyed by series and period.

Raw rows are folded to one row per series and calendar period first; from there a
series is as long as its calendar, whatever the number of rows behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.operators import windows as W
from tallgrass.operators.ordered import ewma

# Large-sample critical values of the unit-root test with a constant.
DICKEY_FULLER_CRITICAL = {"1%": -3.43, "5%": -2.86, "10%": -2.57}


def _series(keys: list[str], order: str):
    return Window.partitionBy(*keys).orderBy(order)


def daily_totals(df: DataFrame, keys: list[str], ts: str, value: str) -> DataFrame:
    return df.groupBy(*keys, F.to_date(ts).alias("day")).agg(F.sum(value).alias("total"))


def monthly_mean(df: DataFrame, keys: list[str], ts: str, value: str) -> DataFrame:
    """Mean of the daily totals per month, with a row for months without data."""
    daily = daily_totals(df, keys, ts, value)
    months = daily.groupBy(*keys, F.trunc("day", "MM").alias("month")).agg(
        (F.sum("total").cast("double") / F.count("total")).alias("value"))
    span = months.groupBy(*keys).agg(F.min("month").alias("_a"), F.max("month").alias("_b"))
    spine = span.select(*keys, F.explode(F.sequence("_a", "_b", F.expr("interval 1 month"))).alias("month"))
    return spine.join(months, [*keys, "month"], "left")


def log_detrend(df: DataFrame, keys: list[str], period: str, value: str, *, window: int = 12, halflife: float = 12) -> DataFrame:
    """Log series, less its moving mean, less its weighted mean, and differenced."""
    logged = df.withColumn("log_value", F.ln(value))
    out = W.rolling(logged, keys, period, "log_value", periods=window, fns={"_mean": F.avg("log_value")})
    out = ewma(out, keys, [period], "log_value", halflife=halflife, name="_ewma")
    out = W.change(out, keys, period, "log_value", name="log_change")
    return out.select(*keys, period, "log_value", (F.col("log_value") - F.col("_mean")).alias("less_mean"),
                      (F.col("log_value") - F.col("_ewma")).alias("less_ewma"), "log_change")


def decompose_additive(df: DataFrame, keys: list[str], period: str, value: str, *, season: int = 12) -> DataFrame:
    """Trend by a centred moving average, seasonal means summing to zero, remainder.

    For an even season both ends of the average weigh half. Trend and remainder are
    null within half a season of either end.
    """
    half = season // 2
    w = _series(keys, period)
    middle = w.rowsBetween(-half, half)
    x = F.col(value)
    total = F.sum(x).over(middle)
    if season % 2 == 0:
        total = total - 0.5 * (F.lag(value, half).over(w) + F.lead(value, half).over(w))
    full = F.count(x).over(middle) == 2 * half + 1
    placed = df.withColumn("trend", F.when(full, total / season)).withColumn(
        "_phase", (F.row_number().over(w) - 1) % season)
    means = placed.groupBy(*keys, "_phase").agg(F.avg(x - F.col("trend")).alias("_mean"))
    centred = means.withColumn("seasonal", F.col("_mean") - F.avg("_mean").over(Window.partitionBy(*keys)))
    joined = placed.join(centred.drop("_mean"), [*keys, "_phase"])
    return joined.withColumn("residual", x - F.col("trend") - F.col("seasonal")).drop("_phase")


def box_figures(df: DataFrame, keys: list[Column], value: str) -> DataFrame:
    """Quartiles of period values by calendar part; groups hold one value per period."""
    return df.groupBy(*keys).agg(
        F.min(value).alias("low"), F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("_q"),
        F.max(value).alias("high")).select("*", *[F.col("_q")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))]).drop("_q")


def dickey_fuller(df: DataFrame, keys: list[str], period: str, value: str) -> DataFrame:
    """Unit-root t statistic of each series from the regression of changes on levels."""
    before = F.lag(value).over(_series(keys, period))
    pairs = df.select(*keys, before.alias("_x"), (F.col(value) - before).alias("_y")).where("_x IS NOT NULL AND _y IS NOT NULL")
    sums = pairs.groupBy(*keys).agg(F.count("_y").alias("n_obs"), F.regr_sxx("_y", "_x").alias("_sxx"),
                                    F.regr_syy("_y", "_x").alias("_syy"), F.regr_sxy("_y", "_x").alias("_sxy"))
    slope = F.try_divide("_sxy", "_sxx")
    error = F.sqrt(F.try_divide(F.try_divide(F.col("_syy") - slope * F.col("_sxy"), F.col("n_obs") - 2), F.col("_sxx")))
    statistic = F.try_divide(slope, error)
    return sums.select(*keys, "n_obs", statistic.alias("statistic"),
                       *[(statistic < v).alias(f"stationary_{n[:-1]}") for n, v in DICKEY_FULLER_CRITICAL.items()])


def split_series(df: DataFrame, keys: list[str], period: str, *, train: int) -> DataFrame:
    """First ``train`` periods of each series as train, the rest as test."""
    place = F.row_number().over(_series(keys, period))
    return df.withColumn("split", F.when(place <= train, "train").otherwise("test"))


def forecast_naive(df: DataFrame, keys: list[str], period: str, value: str, *, horizon: int, season: int = 12) -> DataFrame:
    """Last season repeated, moved by the mean seasonal change for every season ahead."""
    latest = Window.partitionBy(*keys).orderBy(F.desc(period))
    marked = df.withColumn("_back", F.row_number().over(latest)).withColumn(
        "_step", F.col(value) - F.lag(value, season).over(_series(keys, period)))
    drift = marked.groupBy(*keys).agg(F.avg("_step").alias("_drift"), F.max(period).alias("_end"))
    last = marked.where(F.col("_back") <= season).select(*keys, "_back", F.col(value).alias("_base"))
    # every step of every series; null where the series has no value a season before it
    ahead = drift.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    ahead = ahead.withColumn("_back", season - F.pmod(F.col("step") - 1, F.lit(season))).join(last, [*keys, "_back"], "left")
    seasons = F.ceil(F.col("step") / season)
    return ahead.select(*keys, "step", F.add_months("_end", F.col("step").cast("int")).alias(period),
                        (F.col("_base") + seasons * F.coalesce("_drift", F.lit(0.0))).alias("forecast"))


def forecast_ar(df: DataFrame, keys: list[str], period: str, value: str, *, horizon: int, season: int = 12) -> DataFrame:
    """Autoregression of seasonal differences on their last two, by least squares per series.

    The normal equations are solved from means and covariances, which are one aggregate per
    series; the forecast then runs on from the last season and the last two differences. Where
    the two lags tell nothing different, the second is left out, and where they don't vary, both.
    A series too short to fit has null forecasts.
    """
    order = _series(keys, period)
    step = df.select(*keys, period, value, (F.col(value) - F.lag(value, season).over(order)).alias("_d"))
    lagged = step.select("*", F.lag("_d", 1).over(order).alias("_a"), F.lag("_d", 2).over(order).alias("_b"),
                         F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(period))).alias("_back"))
    fitting = F.col("_d").isNotNull() & F.col("_a").isNotNull() & F.col("_b").isNotNull()
    y, a, b = (F.when(fitting, F.col(c)) for c in ("_d", "_a", "_b"))
    at = F.struct((-F.col("_back")).alias("o"), F.col(value).cast("double").alias("v"))
    sums = lagged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.max(period).alias("_end"), F.avg(y).alias("my"), F.avg(a).alias("ma"), F.avg(b).alias("mb"),
        F.var_pop(a).alias("aa"), F.var_pop(b).alias("bb"), F.covar_pop(a, b).alias("ab"), F.covar_pop(a, y).alias("ay"), F.covar_pop(b, y).alias("by"),
        F.max(F.when(F.col("_back") == 1, F.col("_d"))).alias("d1"), F.max(F.when(F.col("_back") == 2, F.col("_d"))).alias("d2"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("_back") <= season, at))), lambda x: x["v"]).alias("_last"))
    aa, bb, ab, ay, by = (F.col(c) for c in ("aa", "bb", "ab", "ay", "by"))
    det = aa * bb - ab * ab
    two = det > 1e-12 * aa * bb
    first = F.when(two, F.try_divide(ay * bb - by * ab, det)).otherwise(F.coalesce(F.try_divide(ay, aa), F.lit(0.0)))
    second = F.when(two, F.try_divide(by * aa - ay * ab, det)).otherwise(F.lit(0.0))
    fitted = sums.withColumns({"b1": first, "b2": second})
    start = F.struct(F.col("d1").alias("p"), F.col("d2").alias("q"), F.col("_last").alias("levels"))
    base = F.col("my") - F.col("b1") * F.col("ma") - F.col("b2") * F.col("mb")

    def ahead(state: Column, h: Column) -> Column:
        change = base + F.col("b1") * state["p"] + F.col("b2") * state["q"]
        level = F.element_at(state["levels"], h.cast("int")) + change
        return F.struct(change.alias("p"), state["p"].alias("q"), F.concat(state["levels"], F.array(level)).alias("levels"))

    made = F.slice(F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, ahead)["levels"], season + 1, horizon)
    enough = (F.col("_n") >= season + 6) & (F.size("_last") == season)
    rows = fitted.select(*keys, "_end", F.posexplode(F.when(enough, made).otherwise(F.array_repeat(F.lit(None).cast("double"), horizon))).alias("_i", "forecast"))
    return rows.select(*keys, (F.col("_i") + 1).alias("step"), F.add_months("_end", F.col("_i") + 1).alias(period), "forecast")


def forecast(df: DataFrame, keys: list[str], period: str, value: str, *, horizon: int, season: int = 12,
             method: str = "naive") -> DataFrame:
    """Forecast by method: ``naive`` (season repeated with drift) or ``ar``."""
    methods = {"naive": forecast_naive, "ar": forecast_ar}
    if method not in methods:
        raise ValueError(f"unknown method {method!r}; use one of {sorted(methods)}")
    return methods[method](df, keys, period, value, horizon=horizon, season=season)


def mape(df: DataFrame, actual: str, predicted: str, keys: list[str] = ()) -> DataFrame:
    """Mean absolute error relative to the actual value; zero actuals are left out."""
    error = F.try_divide(F.abs(F.col(actual) - F.col(predicted)), F.abs(F.col(actual)))
    return df.groupBy(*keys).agg(F.avg(error).alias("mape"))


def weekly_kpis(lines: DataFrame, ts: str, order_id: str, *, week_start: str) -> DataFrame:
    """Order and line figures of one week: lines per order, busiest day, total lines."""
    day = F.to_date(ts)
    start = F.lit(week_start).cast("date")
    week = lines.where((day >= start) & (day < F.date_add(start, 7)))
    per_order = week.groupBy(day.alias("day"), order_id).agg(F.count(F.lit(1)).alias("_lines"))
    daily = per_order.groupBy("day").agg(F.count(order_id).alias("orders"), F.sum("_lines").alias("lines"))
    ratio = F.col("lines") / F.col("orders")
    busiest = F.max_by("day", F.struct("lines", F.negate(F.datediff("day", start))))
    return daily.agg(F.avg(ratio).alias("mean_lines_per_order"), F.max(ratio).alias("max_lines_per_order"),
                     F.date_format(busiest, "EEEE").alias("busiest_day"), F.max("lines").alias("max_lines"),
                     F.sum("lines").alias("total_lines"), F.sum("orders").alias("total_orders"))
