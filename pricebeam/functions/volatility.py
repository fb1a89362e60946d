"""Annualized volatility: population deviation of log returns times sqrt(252), four decimals.

Nulls are dropped before returns are taken, fewer than two prices give 0.0, and any consecutive
ratio that is not a positive finite number makes the whole frame NaN.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

TRADING_DAYS = 252
DECIMALS = 4
NAN = float("nan")
BROKEN_UNIT = 1 << 32


def _annualized(deviation: Column) -> Column:
    return F.round(deviation * F.sqrt(F.lit(float(TRADING_DAYS))), DECIMALS)


def _usable(ratio: Column) -> Column:
    """True only for a positive finite ratio. Spark orders NaN above infinity, so `<` excludes it."""
    return F.coalesce((ratio > 0.0) & (ratio < float("inf")), F.lit(False))


def with_prior_return(df: DataFrame, window: WindowSpec, price: str,
                      log_return: str, broken: str) -> DataFrame:
    """Add the log return against the previous non-null price and a 0/1 flag for an unusable ratio.

    Both are null on rows without a price. A price with no predecessor has return null, flag 0.
    """
    previous = F.last(F.col(price), ignorenulls=True).over(
        window.rowsBetween(Window.unboundedPreceding, -1))
    ratio = F.try_divide(F.col(price), F.col("_previous"))
    comparable = F.col(price).isNotNull() & F.col("_previous").isNotNull()
    return (
        df.withColumn("_previous", previous)
        .withColumns({
            log_return: F.when(comparable & _usable(ratio), F.ln(ratio)),
            broken: F.when(F.col(price).isNotNull(), (comparable & ~_usable(ratio)).cast("int")),
        })
        .drop("_previous")
    )


def with_frame_volatility(df: DataFrame, window: WindowSpec, price: str, rows: int,
                          out: str = "volatility") -> DataFrame:
    """Volatility of the trailing `rows`-row frame, from running window sums.

    The first price in a frame carries the return against a price outside it, so that one return is
    taken off the sums again. No array is built per row, and the columns depend on no row further
    back than the frame, which is what lets `over_series` cut a long series into slices.
    """
    frame = window.rowsBetween(-(rows - 1), Window.currentRow)
    has_price = F.col(price).isNotNull()
    entering = F.when(F.col("_broken") == 1, F.lit(NAN)).otherwise(F.coalesce("_ret", F.lit(0.0)))
    # A sliding sum visits every row of the frame, so the frame is summed in few plain numbers: one
    # long counts prices in its low part and broken ratios in its high part.
    sums = (
        with_prior_return(df, window, price, "_ret", "_broken")
        .withColumns({
            "_entering": F.when(has_price, entering),
            "_square": F.col("_ret") * F.col("_ret"),
            "_counts": F.when(has_price, F.lit(1) + F.col("_broken") * F.lit(BROKEN_UNIT)),
        })
        .withColumns({
            "_s1": F.sum("_ret").over(frame),
            "_s2": F.sum("_square").over(frame),
            "_counts": F.sum("_counts").over(frame),
            "_first": F.first("_entering", ignorenulls=True).over(frame),
        })
    )
    first = F.nanvl("_first", F.lit(0.0))
    prices = F.coalesce(F.col("_counts") % BROKEN_UNIT, F.lit(0))
    broken = F.col("_counts") >= F.when(F.isnan("_first"), 2 * BROKEN_UNIT).otherwise(BROKEN_UNIT)
    pairs = F.nullif(prices - F.lit(1), F.lit(0))
    mean = (F.coalesce("_s1", F.lit(0.0)) - first) / pairs
    mean_square = (F.coalesce("_s2", F.lit(0.0)) - first * first) / pairs
    variance = F.greatest(mean_square - mean * mean, F.lit(0.0))
    volatility = (
        F.when(prices < 2, F.lit(0.0))
        .when(broken, F.lit(NAN))
        .otherwise(_annualized(F.sqrt(variance)))
    )
    return sums.withColumn(out, volatility).drop(
        "_ret", "_broken", "_entering", "_square", "_s1", "_s2", "_counts", "_first")


def group_volatility(price: str, log_return: str, broken: str) -> Column:
    """Aggregate form, over the columns `with_prior_return` made with the same grouping."""
    return (
        F.when(F.count(F.col(price)) < 2, F.lit(0.0))
        .when(F.max(F.col(broken)) > 0, F.lit(NAN))
        .otherwise(_annualized(F.stddev_pop(F.col(log_return))))
    )


# Volatility of one array, in SQL so that it serves both DataFrame and SQL callers. One pass keeps
# the previous price and the running sums.
ARRAY_VOLATILITY_SQL = f"""
CASE WHEN {{a}} IS NULL OR size({{a}}) < 2 THEN 0.0D
ELSE aggregate(
  {{a}},
  named_struct('previous', CAST(NULL AS DOUBLE), 's1', 0.0D, 's2', 0.0D, 'n', 0, 'broken', 0),
  (acc, p) -> CASE
    WHEN p IS NULL THEN acc
    WHEN acc.previous IS NULL THEN named_struct(
      'previous', CAST(p AS DOUBLE), 's1', acc.s1, 's2', acc.s2, 'n', acc.n, 'broken', acc.broken)
    WHEN coalesce(try_divide(p, acc.previous) > 0
         AND try_divide(p, acc.previous) < double('infinity'), false) THEN named_struct(
      'previous', CAST(p AS DOUBLE),
      's1', acc.s1 + ln(p / acc.previous),
      's2', acc.s2 + ln(p / acc.previous) * ln(p / acc.previous),
      'n', acc.n + 1, 'broken', acc.broken)
    ELSE named_struct(
      'previous', CAST(p AS DOUBLE), 's1', acc.s1, 's2', acc.s2, 'n', acc.n + 1, 'broken', 1)
  END,
  acc -> CASE
    WHEN acc.n = 0 OR acc.broken > 0 THEN double('NaN')
    ELSE round(sqrt(greatest(acc.s2 / acc.n - (acc.s1 / acc.n) * (acc.s1 / acc.n), 0.0D))
               * sqrt({TRADING_DAYS}.0D), {DECIMALS}) END)
END"""


def array_volatility(prices: str) -> Column:
    """Volatility of an array column. A raw length of two or more with at most one price is NaN."""
    return F.expr(ARRAY_VOLATILITY_SQL.format(a=prices))
