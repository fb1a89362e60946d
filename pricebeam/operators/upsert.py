"""Keyed upserts without a merge-capable table format."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


class DuplicateKeyError(ValueError):
    """The source of an upsert holds a key twice, so the update would be ambiguous."""


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows replace target rows with the same key; the rest of both is kept.

    A null key equals nothing, so such a row is inserted. The join has no hint: Spark broadcasts the
    source only below its own size threshold and shuffles otherwise.
    """
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source.select(*target.columns))


def upsert_computed(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same for a source that is costly to compute: it is computed once, and one shuffle by key
    tells which target rows it replaces. Rows with a null key stay whatever the source has; they are
    spread by their content, since they equal nothing."""
    columns = target.columns
    both = target.select(*columns, F.lit(False).alias("_new")).unionByName(
        source.select(*columns, F.lit(True).alias("_new")))
    complete = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    spread = F.when(~complete, F.xxhash64(*columns)).otherwise(F.lit(0))
    replaced = F.max("_new").over(Window.partitionBy(*keys, "_spread"))
    return (both.withColumn("_spread", spread).withColumn("_replaced", replaced)
            .filter(F.col("_new") | ~F.col("_replaced") | ~complete).select(*columns))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)


def require_unique(source: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a complete key occurs twice."""
    found = duplicate_keys(source.dropna(subset=list(keys)), keys).take(1)
    if found:
        raise DuplicateKeyError(f"duplicate upsert key {found[0].asDict()}")
