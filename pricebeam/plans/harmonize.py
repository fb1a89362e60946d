"""Raw rows to harmonized rows, and harmonized rows to metric inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pricebeam.functions.normalize import normalize
from pricebeam.functions.volatility import with_frame_volatility
from pricebeam.operators.dedupe import dedupe_latest
from pricebeam.operators.rollups import LONG_FRAME_ROWS


def harmonized_columns(raw: DataFrame) -> DataFrame:
    """The harmonized names and types; other columns (load stamps) stay for choosing the newest."""
    extra = [c for c in raw.columns
             if c not in ("date", "index_name", "index_value", "daily_return", "monthly_return")]
    return raw.select(
        F.col("date").cast("timestamp_ntz").alias("timestamp"),
        F.col("index_name"),
        F.col("index_value").cast("double").alias("value"),
        F.col("daily_return").cast("double").alias("daily_return"),
        F.col("monthly_return").cast("double").alias("monthly_return"),
        *extra,
    )


def harmonize(raw: DataFrame, newest_by: tuple[str, ...] = ()) -> DataFrame:
    """One row per (timestamp, index); the newest load wins."""
    rows = dedupe_latest(harmonized_columns(raw), ["timestamp", "index_name"], list(newest_by))
    return rows.select("timestamp", "index_name", "value", "daily_return", "monthly_return")


def with_volatility(harmonized: DataFrame, source_col: str = "normalized_value") -> DataFrame:
    """Add the sign-normalized value and the thirty-row volatility of `source_col`.

    On the normalized value, the stored contract, volatility is zero for any all-positive series;
    pass `source_col="value"` for the volatility of prices.
    """
    window = Window.partitionBy("index_name").orderBy("timestamp")
    normalized = harmonized.withColumn("normalized_value", normalize("value"))
    return with_frame_volatility(normalized, window, source_col, LONG_FRAME_ROWS)


def performance_input(harmonized: DataFrame) -> DataFrame:
    """(date, index_name, value, daily_return) as the performance operators read it."""
    return harmonized.select(F.col("timestamp").cast("date").alias("date"), "index_name", "value",
                             "daily_return")


def daily_metrics(harmonized: DataFrame) -> DataFrame:
    """One row per (date, index): the latest timestamp of a day wins."""
    days = harmonized.select(F.col("timestamp").cast("date").alias("date"), "index_name",
                             F.col("value").alias("index_value"), "daily_return", "timestamp")
    return dedupe_latest(days, ["date", "index_name"], ["timestamp"],
                         unique_order=True).drop("timestamp")
