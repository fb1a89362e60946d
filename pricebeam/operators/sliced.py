"""Row-frame windows over series of any length."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F, types as T

from pricebeam.functions.returns import pct_change
from pricebeam.session import materialize

# A series with more rows than this is cut, into slices of about a quarter of it: small enough that
# slices of one series spread evenly over tasks, large enough that halos stay negligible.
MAX_ROWS_PER_TASK = 1_000_000
SLICES_PER_LIMIT = 4
# Sampled rows expected of a series at the limit, when its size is estimated.
SAMPLED_AT_LIMIT = 1_000


def over_series(df: DataFrame, series: Sequence[str], order: Sequence[str], lookback: int,
                compute: Callable[[DataFrame, WindowSpec], DataFrame],
                max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """Apply `compute(df, window)`, whose columns look back at most `lookback` rows, per series.

    A series with one row per day is bounded by the calendar and needs none of this. Where a series
    may hold any number of rows, its size is estimated first, from one pass over the series column.
    Series within `max_rows` take the plain window. Longer ones are range-partitioned by
    (series, order), so one series spreads over many tasks; each slice then gets the last
    `lookback` rows before it as a halo, which is dropped after the window. No row is lost or cut,
    and the result equals the plain window's: on both ways rows that tie in `order` follow the
    remaining columns (those that have an order), so that ties fall alike.
    """
    series, order = list(series), _whole_order(df, list(series), order)
    hot, hot_keys, hot_rows, rows = _long_series(df, series, max_rows)
    if not hot_keys:
        return compute(_spread(df, series, rows), Window.partitionBy(*series).orderBy(*order))

    keys, same = _hot_keys(hot, series)
    cold_result = compute(_spread(df.join(keys, same, "left_anti"), series, rows - hot_rows),
                          Window.partitionBy(*series).orderBy(*order))
    sliced = _slice(df.join(keys, same, "left_semi"), series, order,
                    ceil(SLICES_PER_LIMIT * hot_rows / max_rows))
    return cold_result.unionByName(_over_slices(sliced, series, order, lookback, compute, hot_rows))


def filled_over_series(df: DataFrame, series: Sequence[str], order: Sequence[str], value: str, out: str,
                       max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """Adds `out`: the last non-null `value` at or before each row of its series, which may have any length.

    A value can be carried over any distance, so no halo is long enough. Series over `max_rows` are cut into
    slices instead, and filled in two levels: the last known value of each slice; a pass over these, one row
    per slice, that tells each slice what the ones before it leave; and a window within each slice. Ties in
    `order` follow the remaining columns, as in `over_series`, so the result equals the plain window's.
    """
    series, order = list(series), _whole_order(df, series, order)

    def fill(rows: DataFrame, *by: str) -> Column:
        window = Window.partitionBy(*series, *by).orderBy(*order)
        return F.last(value, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))

    hot, hot_keys, hot_rows, rows = _long_series(df, series, max_rows)
    if not hot_keys:
        return _spread(df, series, rows).withColumn(out, fill(df))
    keys, same = _hot_keys(hot, series)
    cold = _spread(df.join(keys, same, "left_anti"), series, rows - hot_rows)
    sliced = _slice(df.join(keys, same, "left_semi"), series, order, ceil(SLICES_PER_LIMIT * hot_rows / max_rows))
    known = F.when(F.col(value).isNotNull(), F.struct(*order))
    lasts = sliced.groupBy(*series, "_slice").agg(F.max_by(value, known).alias("_last"))
    before = Window.partitionBy(*series).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select(*[F.col(c).alias(f"_of_{c}") for c in series], F.col("_slice").alias("_of_slice"),
                           F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    of = _all([*(F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in series), F.col("_slice") == F.col("_of_slice")])
    met = _spread(sliced.join(carried, of), [*series, "_slice"], hot_rows).withColumn(out, F.coalesce(fill(sliced, "_slice"), "_carried"))
    return cold.withColumn(out, fill(cold)).unionByName(met.select(*df.columns, out))


def returns_over_series(df: DataFrame, series: Sequence[str], order: Sequence[str], value: str, lags: dict[str, int],
                        fill: str = "pad", max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """Percent changes (see `with_returns`) along series of any length."""
    padded = value
    if fill == "pad":
        padded = "_padded"
        df = filled_over_series(df, series, order, value, padded, max_rows)
    elif fill != "none":
        raise ValueError(f"fill must be 'pad' or 'none', not {fill!r}")

    def changes(rows: DataFrame, window: WindowSpec) -> DataFrame:
        return rows.withColumns({n: pct_change(F.col(padded), window, k) for n, k in lags.items()})

    kept = [c for c in df.columns if c != "_padded"]
    return over_series(df, series, order, max(lags.values()), changes, max_rows).select(*kept, *lags)


def _whole_order(df: DataFrame, series: list[str], order: Sequence[str]) -> list[str]:
    """The order, then the remaining columns that have one, so that ties fall alike on every way."""
    return [*order, *(f.name for f in df.schema.fields if f.name not in (*series, *order)
                      and not isinstance(f.dataType, (T.MapType, T.VariantType)))]


def _hot_keys(hot: DataFrame, series: list[str]) -> tuple[DataFrame, Column]:
    keys = materialize(hot.select(*[F.col(c).alias(f"_hot_{c}") for c in series]), "hot-series")
    return keys, _all(F.col(c).eqNullSafe(F.col(f"_hot_{c}")) for c in series)


def _long_series(df: DataFrame, series: list[str], max_rows: int) -> tuple[DataFrame, int, float, float]:
    """Keys of series over `max_rows` with their size; how many these are, their rows, and all rows.

    The sample only decides which way a series is computed, never which rows are: both ways give
    the same result, so a wrong estimate costs time. It keeps the shuffle of this pass at a
    thousandth of the rows for a limit of a million.
    """
    share = min(1.0, SAMPLED_AT_LIMIT / max_rows)
    sampled = df.select(*series)
    if share < 1.0:
        sampled = sampled.sample(share, seed=1)
    sizes = sampled.groupBy(*series).agg((F.count(F.lit(1)) / share).alias("_rows"))
    long = F.col("_rows") > max_rows
    keys, hot_rows, rows = sizes.agg(F.count_if(long), F.sum(F.when(long, F.col("_rows"))), F.sum("_rows")).first()
    return sizes.filter(long), keys, hot_rows or 0, rows or 0


def _spread(df: DataFrame, keys: list[str], rows: float) -> DataFrame:
    """Rows of one key together, in so many tasks that none sorts much more than the limit. The session's number
    of shuffle partitions does not follow the rows; where it is enough, nothing is changed."""
    tasks = ceil(rows / MAX_ROWS_PER_TASK)
    if tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df
    return df.repartition(tasks, *keys)


def _all(conditions) -> Column:
    return reduce(Column.__and__, conditions)


def _slice(df: DataFrame, series: list[str], order: list[str], slices: int) -> DataFrame:
    """Cut into order ranges of similar size. The ranges come from sampling, so they are written out
    once and every later step reads the same cut."""
    ranged = df.repartitionByRange(max(slices, 2), *series, *order)
    return materialize(ranged.withColumn("_slice", F.spark_partition_id()), "slices")


def _over_slices(sliced: DataFrame, series: list[str], order: list[str], lookback: int,
                 compute: Callable[[DataFrame, WindowSpec], DataFrame], rows: float) -> DataFrame:
    body = sliced.withColumn("_halo", F.lit(False))
    if lookback:
        body = body.unionByName(_halo_rows(sliced, series, order, lookback, rows))
    body = _spread(body, [*series, "_slice"], rows)
    window = Window.partitionBy(*series, "_slice").orderBy(*order)
    return compute(body, window).filter(~F.col("_halo")).drop("_halo", "_slice")


def _halo_rows(sliced: DataFrame, series: list[str], order: list[str],
               lookback: int, rows: float) -> DataFrame:
    """The last rows of each slice, addressed to the later slices that look back at them.

    Only slice tails can be looked back at, and the row limit is applied before the shuffle. Which
    slices need a tail follows from the slices' sizes alone, one row per series and slice: a row
    `k` places from its slice's end is needed by the slices that begin within the next
    `lookback - k` rows, which also covers slices shorter than the lookback.
    """
    sizes = sliced.groupBy(*series, "_slice").agg(F.count(F.lit(1)).alias("_size"))
    later = Window.partitionBy(*series).orderBy("_slice").rowsBetween(1, lookback)
    readers = sizes.select(
        *[F.col(c).alias(f"_of_{c}") for c in series], F.col("_slice").alias("_of_slice"),
        F.collect_list(F.struct("_slice", "_size")).over(later).alias("_later"))
    # Rows between the end of a slice and the beginning of each later one.
    readers = readers.withColumn("_later", F.transform("_later", lambda x, i: F.struct(
        x["_slice"].alias("slice"),
        F.aggregate(F.slice("_later", F.lit(1), i), F.lit(0).cast("long"),
                    lambda total, y: total + y["_size"]).alias("between"))))
    from_end = Window.partitionBy(*series, "_slice").orderBy(*[F.desc(c) for c in order])
    tails = (
        _spread(sliced, [*series, "_slice"], rows).withColumn("_from_end", F.row_number().over(from_end) - 1)
        .filter(F.col("_from_end") < lookback)
    )
    same = _all([*(F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in series),
                 F.col("_slice") == F.col("_of_slice")])
    needed = F.filter("_later", lambda x: x["between"] + F.col("_from_end") < lookback)
    return (
        tails.join(readers, same)
        .withColumn("_slice", F.explode(F.transform(needed, lambda x: x["slice"])))
        .withColumn("_halo", F.lit(True))
        .select(*sliced.columns, "_halo")
    )
