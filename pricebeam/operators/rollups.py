"""Monthly, weekly and daily derivations. Every aggregation here combines before its shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricebeam.functions.dates import month_start, trailing_days, week_start
from pricebeam.functions.volatility import (
    group_volatility,
    with_frame_volatility,
    with_prior_return,
)

FRAME_ROWS = 21
LONG_FRAME_ROWS = 30
LOOKBACK_DAYS = 30
LOOKBACK_WEEK_DAYS = 28


def daily_series_window() -> Window:
    """One row per (date, index): at most 366 rows a year in any window group, however much raw
    data lies behind it, because duplicates are aggregated away before this window."""
    return Window.partitionBy("index_name").orderBy("date")


def monthly_max_return(df: DataFrame, day: str = "date") -> DataFrame:
    """Highest monthly return per month and index."""
    return df.groupBy(month_start(day).alias("month"), "index_name").agg(
        F.max("monthly_return").alias("monthly_return"))


def current_month_max_return(df: DataFrame, as_of: Column, day: str = "date") -> DataFrame:
    """The same for the month of `as_of` only, up to `as_of`."""
    recent = df.filter(F.col(day).between(month_start(as_of), as_of))
    return monthly_max_return(recent, day)


def monthly_average(df: DataFrame, day: str = "date", value: str = "index_value") -> DataFrame:
    return df.groupBy(month_start(day).alias("month"), "index_name").agg(
        F.avg(value).alias("avg_index_value"))


def weekly_averages(df: DataFrame, day: str = "date", value: str = "index_value") -> DataFrame:
    """Average value and average daily return per Monday week and index."""
    return df.groupBy(week_start(day).alias("week"), "index_name").agg(
        F.avg(value).alias("avg_index_value"), F.avg("daily_return").alias("avg_daily_return"))


def range_over_minimum(value: str) -> Column:
    return F.try_divide(F.max(value) - F.min(value), F.min(value))


def weekly_performance(df: DataFrame, day: str = "date", value: str = "value") -> DataFrame:
    """Average, in-week range over minimum, and in-week volatility in date order.

    Input has one row per (date, index), so a group holds at most seven rows. The window and the
    aggregation share their keys: one exchange.
    """
    weekly = df.select(week_start(day).alias("week_start"), "index_name",
                       F.col(day).alias("_day"), F.col(value).alias("_value"))
    in_week = Window.partitionBy("week_start", "index_name").orderBy("_day")
    priced = with_prior_return(weekly, in_week, "_value", "_ret", "_broken")
    return priced.groupBy("week_start", "index_name").agg(
        F.avg("_value").alias("avg_value"),
        range_over_minimum("_value").alias("weekly_return"),
        group_volatility("_value", "_ret", "_broken").alias("volatility"),
    )


def weekly_price_arrays(df: DataFrame, day: str = "date", value: str = "value") -> DataFrame:
    """Prices of each week as one array in date order, nulls left out. Input has one row per
    (date, index), so an array holds at most seven prices."""
    dated = F.sort_array(F.collect_list(F.struct(F.col(day).alias("d"), F.col(value).alias("v"))))
    prices = F.filter(F.transform(dated, lambda x: x["v"]), lambda v: v.isNotNull())
    return df.groupBy(week_start(day).alias("week_start"), "index_name").agg(prices.alias("prices"))


def frame_prices(df: DataFrame, rows: int = FRAME_ROWS, value: str = "value",
                 window: Window | None = None) -> DataFrame:
    """The non-null prices of the trailing frame, in order, as an array column."""
    frame = (window or daily_series_window()).rowsBetween(-(rows - 1), 0)
    return df.withColumn("prices", F.collect_list(value).over(frame))


def daily_performance(df: DataFrame, rows: int = FRAME_ROWS) -> DataFrame:
    """Daily value and return with the volatility of the trailing frame. One row per (date, index)."""
    return with_frame_volatility(df, daily_series_window(), "value", rows).select(
        "date", "index_name", "value", "daily_return", "volatility")


def recent_daily_performance(df: DataFrame, as_of: Column, days: int = LOOKBACK_DAYS,
                             rows: int = FRAME_ROWS, strict_reference: bool = False) -> DataFrame:
    """Daily performance of the last `days` days up to `as_of`.

    By default the frame sees the whole history before the first reported day, so a refresh never
    replaces a full frame by a cut one. `strict_reference` filters before the window instead.
    """
    if strict_reference:
        return daily_performance(df.filter(trailing_days("date", as_of, days)), rows)
    return daily_performance(df.filter(F.col("date") <= as_of), rows).filter(
        trailing_days("date", as_of, days))


def recent_weekly_performance(df: DataFrame, as_of: Column, days: int = LOOKBACK_WEEK_DAYS,
                              strict_reference: bool = False) -> DataFrame:
    """Weekly performance of the last four weeks up to `as_of`.

    By default the first week is read from its Monday; `strict_reference` starts mid-week.
    """
    first = F.date_sub(as_of, days)
    if not strict_reference:
        first = week_start(first)
    return weekly_performance(df.filter(F.col("date").between(first, as_of)))
