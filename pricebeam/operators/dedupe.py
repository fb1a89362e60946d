"""Keep one row per key, reproducibly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def dedupe_latest(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str] = (),
                  unique_order: bool = False) -> DataFrame:
    """One row per key: the highest by `newest_by`, then by the remaining columns.

    This is an aggregation, so each task reduces its copies before the shuffle: a key that holds a
    third of all rows sends one row per task, not its rows. With `unique_order` the caller asserts
    that `newest_by` is one non-null column without ties inside a key; then the winner is found by
    hash aggregation instead of sort aggregation.
    """
    rest = [c for c in df.columns if c not in keys and c not in newest_by]
    if unique_order:
        (order,) = newest_by
        picked = df.groupBy(*keys).agg(
            F.max(order).alias(order), *[F.max_by(c, order).alias(c) for c in rest])
        return picked.select(*df.columns)
    if not rest and not newest_by:
        return df.dropDuplicates(list(keys))
    newest = F.max(F.struct(*newest_by, *rest)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(
        *[F.col(c) if c in keys else F.col(f"_newest.{c}").alias(c) for c in df.columns])
