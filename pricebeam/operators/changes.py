"""Change feed between two snapshots of a table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pricebeam.operators.upsert import DuplicateKeyError, duplicate_keys


def snapshot_changes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keyed difference: the key, `op` (insert, update or delete) and the values; a deleted row
    shows the values it had. A key that one of the snapshots holds twice has no one difference:
    DuplicateKeyError."""
    for snapshot in (before, after):
        _require_unique_keys(snapshot, keys)
    values = [c for c in after.columns if c not in keys]
    old = before.select(*[F.col(c).alias(f"_old_{c}") for c in [*keys, *values]],
                        F.lit(True).alias("_in_old"))
    new = after.select(*keys, *values, F.lit(True).alias("_in_new"))
    op = (
        F.when(F.col("_in_old").isNull(), "insert")
        .when(F.col("_in_new").isNull(), "delete")
        .when(~same_key(values, "_old_"), "update")
    )
    deleted = F.col("_in_new").isNull()
    return (
        old.join(new, same_key(keys, "_old_"), "full_outer")
        .withColumn("op", op)
        .filter(F.col("op").isNotNull())
        .select(*[F.when(deleted, F.col(f"_old_{c}")).otherwise(F.col(c)).alias(c)
                  for c in [*keys, *values]], "op")
    )


def _require_unique_keys(snapshot: DataFrame, keys: Sequence[str]) -> None:
    """Here nulls are keys like any other, since the join matches them."""
    found = duplicate_keys(snapshot, keys).take(1)
    if found:
        raise DuplicateKeyError(f"duplicate snapshot key {found[0].asDict()}")


def row_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Keyless difference as a bag: rows gained are inserts, rows lost are deletes. Each snapshot is
    read once: copies of a row are counted, those before against those after, in one aggregation."""
    columns = after.columns
    both = after.select(*columns, F.lit(1).alias("_n")).unionByName(
        before.select(*columns, F.lit(-1).alias("_n")))
    gained = both.groupBy(*columns).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    return gained.select(
        *columns, F.when(F.col("_n") > 0, "insert").otherwise("delete").alias("op"),
        F.explode(F.sequence(F.lit(1), F.abs("_n"))).alias("_copy")).drop("_copy")


def keyed_changes(before: DataFrame, after: DataFrame, keys: Sequence[str], whole: bool) -> DataFrame:
    """`op` (insert, update or delete) with the rows `before` and `after`, of all rows that differ. `after` is
    a `whole` table, or only the rows that are merged into it, and then nothing is deleted. A key occurs once
    on each side; one with a null equals nothing, so its rows are deleted and inserted."""
    columns = after.columns
    old = before.select(*keys, F.struct(*columns).alias("before"))
    new = after.select(*keys, F.struct(*columns).alias("after"))
    op = F.when(F.col("before").isNull(), "insert").when(F.col("after").isNull(), "delete").otherwise("update")
    return (new.join(old, list(keys), "full_outer" if whole else "left_outer")
            .filter(~F.col("before").eqNullSafe(F.col("after"))).select(op.alias("op"), "before", "after"))


def replayed(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """The table after changes with `before` and `after`, from its rows before them. Rows are counted, so the
    order of the changes plays no part; each must be in `changes` once."""
    columns = snapshot.columns
    gained = changes.filter("after IS NOT NULL").select("after.*", F.lit(1).alias("_n"))
    lost = changes.filter("before IS NOT NULL").select("before.*", F.lit(-1).alias("_n"))
    counted = (snapshot.withColumn("_n", F.lit(1)).unionByName(gained).unionByName(lost)
               .groupBy(*columns).agg(F.sum("_n").alias("_n")).filter("_n > 0"))
    return counted.select(*columns, F.explode(F.sequence(F.lit(1), "_n")).alias("_copy")).drop("_copy")


def same_key(columns: Sequence[str], other: str) -> Column:
    """Whether the columns equal those with the prefix `other`, where null equals null."""
    return reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"{other}{c}")) for c in columns], F.lit(True))
