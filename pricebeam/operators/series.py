"""Building and trimming series frames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def date_range(df: DataFrame, start: Column, end: Column, day: str = "date") -> DataFrame:
    """Rows from `start` to `end`, both included."""
    return df.filter(F.col(day).between(start, end))


def union_series(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name."""
    return reduce(DataFrame.unionByName, frames)


def _dimension(df: DataFrame, names: Mapping[str, str] | DataFrame, series_id: str,
               index_name: str) -> DataFrame:
    if isinstance(names, DataFrame):
        return names.select(F.col("series_id").alias(series_id), F.col("index_name").alias(index_name))
    return df.sparkSession.createDataFrame(list(names.items()), f"{series_id} string, {index_name} string")


def tag_series(df: DataFrame, names: Mapping[str, str] | DataFrame,
               series_id: str = "series_id", index_name: str = "index_name") -> DataFrame:
    """Replace `series_id` by the display name, keeping known series only; `unlisted_series` tells of
    the others. `names` is a dict or a DataFrame of (series_id, index_name). The join has no hint, so
    Spark's own size threshold decides."""
    return df.join(_dimension(df, names, series_id, index_name), series_id).drop(series_id)


def unlisted_series(df: DataFrame, names: Mapping[str, str] | DataFrame,
                    series_id: str = "series_id") -> DataFrame:
    """The ids that `names` lacks, with their rows: what `tag_series` leaves out."""
    listed = _dimension(df, names, series_id, "_name").select(series_id)
    return df.groupBy(series_id).agg(F.count(F.lit(1)).alias("rows")).join(listed, series_id, "left_anti")
