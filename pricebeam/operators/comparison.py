"""Comparing indices: correlation, rebasing, trend. Input has one row per (date, index)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pricebeam.operators.rollups import LONG_FRAME_ROWS, daily_series_window


def rebased(df: DataFrame, value: str = "value", base: float = 100.0) -> DataFrame:
    """Each index relative to its own first date, which is `base`."""
    first = F.first(value).over(daily_series_window())
    return df.withColumn("rebased", F.try_divide(F.lit(base) * F.col(value), first))


def moving_average(df: DataFrame, value: str = "value", rows: int = LONG_FRAME_ROWS) -> DataFrame:
    frame = daily_series_window().rowsBetween(-(rows - 1), 0)
    return df.withColumn("moving_average", F.avg(value).over(frame))


def return_correlation(df: DataFrame) -> DataFrame:
    """Pearson correlation of daily returns for every pair of indices, on common dates.

    The indices are those that the data holds. Returns meet on their date, and each pair is one group
    of a partial aggregation, so the plan is the same for any number of names. The result has
    n (n - 1) / 2 rows for n indices, and as many pairs of rows meet on a date: for thousands of
    indices choose those to compare first.
    """
    returns = df.select("date", "index_name", "daily_return")
    left = returns.withColumnsRenamed({"index_name": "index_a", "daily_return": "_a"})
    right = returns.withColumnsRenamed({"index_name": "index_b", "daily_return": "_b"})
    pairs = left.join(right, "date").filter(F.col("index_a") < F.col("index_b"))
    return pairs.groupBy("index_a", "index_b").agg(F.corr("_a", "_b").alias("correlation"))
