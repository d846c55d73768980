"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallgrass.functions.conditions import recode

# Fixed values.
DAY_NAMES = {"MON": "Monday", "TUE": "Tuesday", "WED": "Wednesday", "THU": "Thursday",
             "FRI": "Friday", "SAT": "Saturday", "SUN": "Sunday"}


def month_floor(ts: Column) -> Column:
    return F.trunc(ts, "MM")


def next_month(ts: Column) -> Column:
    return F.add_months(F.trunc(ts, "MM"), 1)


def month_number(ts: Column) -> Column:
    """Months since year 0, so differences count whole calendar months."""
    return F.year(ts) * 12 + F.month(ts)


def months_apart(later: Column, earlier: Column) -> Column:
    return month_number(later) - month_number(earlier)


def iso_week_start(year: Column, week: Column) -> Column:
    """Monday of an ISO week; 4 January always lies in week 1."""
    first = F.trunc(F.make_date(year, F.lit(1), F.lit(4)), "week")
    return F.date_add(first, ((week - 1) * 7).cast("int"))


def serial_day(ts: Column) -> Column:
    """Days since 1899-12-30, with the time of day as a fraction."""
    day = F.to_date(ts)
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.extract(F.lit("SECOND"), ts)
    return F.datediff(day, F.lit("1899-12-30").cast("date")) + seconds.cast("double") / 86400.0


def parse_or_null(text: Column, pattern: str, shape: str) -> Column:
    """Timestamp by pattern, null for other text; ``shape`` sets aside text that cannot
    match, as every failed parse costs an error raised and caught inside."""
    return F.try_to_timestamp(F.when(text.rlike(shape), text), F.lit(pattern))


def full_day_name(short: Column) -> Column:
    return recode(F.upper(short), DAY_NAMES)
