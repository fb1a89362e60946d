"""Weekly averages on an unbounded stream, with a bound on late data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Weeks counted from the epoch start on Thursday; four days later is a Monday.
MONDAY_OFFSET = "4 days"


def weekly_average_stream(ticks: DataFrame, lateness: str = "1 day",
                          keys: tuple[str, ...] = ("ts", "index_name", "event_id")) -> DataFrame:
    """Drop repeated ticks, average per Monday week and index, and emit a week once it is closed.

    Works on batch and streaming frames. State is bounded by the watermark: keys seen within the
    lateness bound and the open weeks.
    """
    if ticks.isStreaming:
        unique = ticks.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(list(keys))
    else:
        unique = ticks.dropDuplicates(list(keys))
    weekly = unique.groupBy(F.window("ts", "1 week", startTime=MONDAY_OFFSET), "index_name").agg(
        F.avg("index_value").alias("avg_index_value"))
    return weekly.select(monday(F.col("window.start")).alias("week"), "index_name", "avg_index_value")


def monday(start: Column) -> Column:
    """The day on which a weekly window starts."""
    return F.to_utc_timestamp(start, F.current_timezone()).cast("date")
