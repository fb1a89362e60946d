"""Percent changes along a series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

RETURN_LAGS = {"daily_return": 1, "monthly_return": 30}


def forward_fill(value: Column, window: WindowSpec) -> Column:
    """Last non-null value at or before the row."""
    return F.last(value, ignorenulls=True).over(
        window.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def pct_change(value: Column, window: WindowSpec, periods: int = 1) -> Column:
    """Change against the row `periods` earlier; null where that row is missing, null or zero."""
    return F.try_divide(value, F.lag(value, periods).over(window)) - F.lit(1.0)


def with_returns(df: DataFrame, window: WindowSpec, value: str = "index_value", fill: str = "pad",
                 lags: dict[str, int] | None = None) -> DataFrame:
    """Add one percent-change column per entry of `lags` (rows, not calendar days).

    `fill="pad"` carries the last known price over gaps first, `fill="none"` leaves gaps null. All
    steps share one window specification: one exchange and one sort however many lags are asked.
    """
    lags = lags or RETURN_LAGS
    if fill == "none":
        return df.withColumns({n: pct_change(F.col(value), window, k) for n, k in lags.items()})
    if fill != "pad":
        raise ValueError(f"fill must be 'pad' or 'none', not {fill!r}")
    padded = df.withColumn("_padded", forward_fill(F.col(value), window))
    return padded.withColumns(
        {n: pct_change(F.col("_padded"), window, k) for n, k in lags.items()}).drop("_padded")
