"""Whole-table replacement: versions, the switch, and their removal by age."""

import datetime as dt

import pytest

from pricebeam import schemas
from pricebeam.sources import tables
from pricebeam.sources.tables import (
    overwrite_table, read_table, remove_old_versions, stored_table, upsert_table)

D = dt.date
SPEC = schemas.MONTHLY_METRICS
OLD = [(D(2024, 1, 1), "a", 1.0), (D(2024, 2, 1), "b", 2.0)]
NEW = [(D(2024, 2, 1), "b", 5.0), (D(2024, 3, 1), "c", 6.0)]
NOON = dt.datetime(2024, 6, 1, 12)
DAY = dt.timedelta(days=1)


def frame(spark, rows):
    return spark.createDataFrame(rows, SPEC.columns)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def current(spark, layers):
    return rows(read_table(spark, layers, SPEC))


def test_a_reader_that_began_before_the_overwrite_gets_the_old_rows(spark, layers):
    overwrite_table(frame(spark, OLD), layers, SPEC)
    reader = read_table(spark, layers, SPEC)
    overwrite_table(frame(spark, NEW), layers, SPEC)
    assert rows(reader) == OLD
    assert current(spark, layers) == NEW


def test_a_table_may_be_rebuilt_from_itself(spark, layers):
    overwrite_table(frame(spark, OLD), layers, SPEC)
    overwrite_table(read_table(spark, layers, SPEC).filter("index_name = 'b'"), layers, SPEC)
    assert current(spark, layers) == OLD[1:]


def test_a_crash_between_write_and_switch_changes_nothing(spark, layers, monkeypatch):
    overwrite_table(frame(spark, OLD), layers, SPEC)
    before = stored_table(spark, layers, SPEC)

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(tables, "_switch", crash)
        with pytest.raises(RuntimeError):
            overwrite_table(frame(spark, NEW), layers, SPEC)
    assert stored_table(spark, layers, SPEC) == before
    assert current(spark, layers) == OLD
    overwrite_table(frame(spark, NEW), layers, SPEC)
    assert current(spark, layers) == NEW


def test_a_failed_write_changes_nothing(spark, layers):
    overwrite_table(frame(spark, OLD), layers, SPEC)
    broken = frame(spark, NEW).selectExpr("month", "index_name", "IF(index_name = 'c', raise_error('bad'), monthly_return) AS monthly_return")
    with pytest.raises(Exception, match="bad"):
        overwrite_table(broken, layers, SPEC)
    assert current(spark, layers) == OLD


def test_upserts_go_into_the_current_version(spark, layers):
    overwrite_table(frame(spark, OLD), layers, SPEC)
    overwrite_table(frame(spark, NEW), layers, SPEC)
    upsert_table(frame(spark, [(D(2024, 3, 1), "c", 9.0), (D(2024, 4, 1), "d", 7.0)]), layers, SPEC)
    assert current(spark, layers) == [NEW[0], (D(2024, 3, 1), "c", 9.0), (D(2024, 4, 1), "d", 7.0)]


def test_old_versions_go_by_the_time_since_they_were_met_out_of_use(spark, layers):
    overwrite_table(frame(spark, OLD), layers, SPEC)
    old = stored_table(spark, layers, SPEC)
    assert remove_old_versions(spark, layers, NOON, DAY) == []      # meets only the first, empty version
    overwrite_table(frame(spark, NEW), layers, SPEC)
    reader = spark.table(old)
    # A day after the first cleanup `old` has been out of use for less than a day.
    gone = remove_old_versions(spark, layers, NOON + DAY, DAY)
    assert old not in gone and len(gone) == 1
    assert rows(reader.drop("part_month")) == OLD
    assert remove_old_versions(spark, layers, NOON + 2 * DAY, DAY) == [old]
    assert not spark.catalog.tableExists(old)
    assert current(spark, layers) == NEW
    assert remove_old_versions(spark, layers, NOON + 9 * DAY, DAY) == []


def test_tables_of_loads_and_plain_tables_have_no_versions(spark, layers):
    assert stored_table(spark, layers, schemas.RAW_STAGING) == layers.name(schemas.RAW_STAGING)
    name = layers.name(SPEC)
    spark.sql(f"DROP VIEW {name}")
    tables._create(spark, name, SPEC)
    for given in (OLD, NEW):
        overwrite_table(frame(spark, given), layers, SPEC)
        assert current(spark, layers) == given
    upsert_table(frame(spark, [(D(2024, 3, 1), "c", 9.0)]), layers, SPEC)
    assert current(spark, layers) == [NEW[0], (D(2024, 3, 1), "c", 9.0)]
