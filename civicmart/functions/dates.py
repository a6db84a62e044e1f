"""Date and number parsing, date keys and calendar columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the second date form found in the request files.
US_TIMESTAMP = "MM/dd/yyyy hh:mm:ss a"


def parse_ts(c: Column) -> Column:
    """Timestamp without zone from ISO text or the US form; NULL when neither reads.

    Sessions run in UTC, where no wall time is skipped, so the zoned step changes nothing.
    """
    text = F.trim(c)
    us_form = F.try_to_timestamp(text, F.lit(US_TIMESTAMP)).cast("timestamp_ntz")
    return F.coalesce(text.try_cast("timestamp_ntz"), us_form)


def parse_coord(c: Column) -> Column:
    return F.trim(c).try_cast("decimal(9,6)")


def date_key(c: Column) -> Column:
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def resolution_days(created: Column, closed: Column) -> Column:
    """Midnights between opening and closing; NULL while open."""
    return F.datediff(F.to_date(closed), F.to_date(created))


def duration_sec(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def us_week(d: Column) -> Column:
    """Week 1 holds 1 January and weeks start on Sunday."""
    first = F.dayofweek(F.trunc(d, "year"))
    return (F.floor((F.dayofyear(d) + first - F.lit(2)) / 7) + 1).cast("int")


def calendar_columns(d: Column) -> list[Column]:
    """The attributes of one calendar day, in table order."""
    weekday = F.dayofweek(d)
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short"),
        us_week(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        weekday.isin(1, 7).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    ]


def year_month_columns(d: Column, last: Column) -> list[Column]:
    """Month text, its sort number, and whether the day is in the month of `last`."""
    in_last = F.trunc(d, "month") == F.trunc(last, "month")
    return [
        F.date_format(d, "yyyy-MM").alias("year_month"),
        (F.year(d) * 100 + F.month(d)).alias("year_month_sort"),
        F.when(in_last, 1).otherwise(0).alias("is_last_month"),
    ]


def hierarchy_columns(d: Column) -> list[Column]:
    """Year, quarter, month and day levels for a drill-down on any date column."""
    return [
        F.year(d).alias("year"),
        F.month(d).alias("month_no"),
        F.date_format(d, "MMMM").alias("month"),
        F.quarter(d).alias("quarter_no"),
        F.concat(F.lit("Qtr "), F.quarter(d).cast("string")).alias("quarter"),
        F.dayofmonth(d).alias("day"),
    ]
