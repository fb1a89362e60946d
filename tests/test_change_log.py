"""The log of changes: replaying it gives the table, whatever died in between."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from pricebeam import schemas
from pricebeam.operators.changes import keyed_changes, replayed
from pricebeam.plans import jobs
from pricebeam.sources import tables
from pricebeam.sources.change_log import REBUILD, ChangeLog
from pricebeam.sources.tables import Layers, change_log, create_layers, overwrite_table, read_table, upsert_table
from pricebeam.streaming.change_feed import drain_changes
from pricebeam.streaming.refresh import load_raw_data, update_daily_index_metrics
from test_jobs import land, series

D = dt.date
DAILY = schemas.DAILY_METRICS
LOGGED = (schemas.HARMONIZED, DAILY, schemas.WEEKLY_METRICS, schemas.DAILY_PERFORMANCE, schemas.WEEKLY_PERFORMANCE)


@pytest.fixture
def logged(spark, scratch):
    root = scratch("tables")
    made = Layers(f"l_{root.rsplit('-', 1)[-1][:10]}_", root, tuple(s.name for s in LOGGED))
    create_layers(spark, made)
    return made


def daily(spark, *rows):
    return spark.createDataFrame([(D(2024, m, d), n, v, None) for m, d, n, v in rows], DAILY.columns)


def plain(rows):
    return sorted(repr(tuple(x)) for x in rows)


def same_as_table(spark, layers, spec):
    empty = spark.createDataFrame([], spec.columns)
    got = replayed(empty, change_log(spark, layers, spec).read())
    assert plain(got.collect()) == plain(read_table(spark, layers, spec).collect()), spec.name


def ops(changes):
    return sorted((x.version, x.op, (x.before or x.after).index_name,
                   x.before and x.before.index_value, x.after and x.after.index_value) for x in changes.collect())


def test_rows_that_differ(spark):
    schema = "k string, v double, w string"
    before = spark.createDataFrame([("same", 1., None), ("nan", math.nan, "x"), ("new value", 1., "x"),
                                    ("now null", 1., "x"), ("gone", 2., "x"), (None, 3., "x")], schema)
    after = spark.createDataFrame([("same", 1., None), ("nan", math.nan, "x"), ("new value", 2., "x"),
                                   ("now null", None, "x"), ("more", 4., "x"), (None, 3., "x")], schema)
    for whole in (True, False):
        changes = keyed_changes(before, after, ["k"], whole)
        found = sorted((x.op, (x.before or x.after).k or "-") for x in changes.collect())
        kept = [("insert", "-"), ("insert", "more"), ("update", "new value"), ("update", "now null")]
        assert found == ([("delete", "-"), ("delete", "gone")] if whole else []) + kept
        if whole:
            assert plain(replayed(before, changes).collect()) == plain(after.collect())


def test_repeated_rows_are_replayed_by_number(spark):
    schema = "k string, v double"
    two = spark.createDataFrame([(None, 1.), (None, 1.), (None, 2.)], schema)
    empty = two.limit(0)
    assert plain(replayed(empty, keyed_changes(empty, two, ["k"], True)).collect()) == plain(two.collect())
    assert replayed(two, keyed_changes(two, empty, ["k"], True)).collect() == []
    assert keyed_changes(empty, empty, ["k"], True).collect() == []


def test_upserts_and_rebuilds_are_noted(spark, logged):
    upsert_table(daily(spark, (1, 1, "a", 1.), (1, 2, "a", 2.), (2, 1, "b", 3.)), logged, DAILY)
    upsert_table(daily(spark, (1, 2, "a", 5.), (2, 1, "b", 3.), (3, 1, "c", 7.)), logged, DAILY)
    upsert_table(daily(spark, (3, 1, "c", 7.)), logged, DAILY)                    # nothing changes: no version
    overwrite_table(daily(spark, (1, 2, "a", 6.), (3, 1, "c", 7.)), logged, DAILY)
    log = change_log(spark, logged, DAILY)
    assert list(log.published().values()) == [1, 2, 3]
    assert ops(log.read()) == [
        (1, "insert", "a", None, 1.), (1, "insert", "a", None, 2.), (1, "insert", "b", None, 3.),
        (2, "insert", "c", None, 7.), (2, "update", "a", 2., 5.),
        (3, "delete", "a", 1., None), (3, "delete", "b", 3., None), (3, "update", "a", 5., 6.)]
    same_as_table(spark, logged, DAILY)
    assert log.trim(3) == 2 and list(log.published().values()) == [3]
    upsert_table(daily(spark, (3, 1, "c", 8.)), logged, DAILY)
    assert ops(log.read())[-1] == (4, "update", "c", 7., 8.)


def test_tables_that_are_not_logged_have_no_log(spark, layers):
    upsert_table(daily(spark, (1, 1, "a", 1.)), layers, DAILY)
    log = change_log(spark, layers, DAILY)
    assert log.published() == {} and log.read().collect() == []


def test_refreshes_late_rows_and_rebuilds_replay(spark, logged, scratch):
    """Corrections, rows of earlier months, a day that moves on and a rebuild; the stream is drained between."""
    landing, load, update, feed = scratch("landing"), scratch("load"), scratch("update"), scratch("feed")
    rows = series(spark, 70, "ab")
    late = F.col("date").between(D(2024, 1, 10), D(2024, 1, 20)) & (F.col("index_name") == "b")
    batches, tokens = [], []

    def keep(changes, token):
        batches.append(changes.collect())
        tokens.append(token)

    steps = ((rows.filter(~late & (F.col("date") < D(2024, 2, 20))), D(2024, 2, 10)),
             (rows.filter(late | (F.col("date") >= D(2024, 2, 20))), D(2024, 3, 31)),
             (rows.filter("day(date) = 7").withColumn("index_value", F.lit(77.)), D(2024, 3, 31)))
    for number, (step, as_of) in enumerate(steps):
        land(step, landing, f"s{number}")
        load_raw_data(spark, logged, f"{landing}/*", load)
        update_daily_index_metrics(spark, logged, update, as_of)
        for spec in LOGGED:
            same_as_table(spark, logged, spec)
        assert drain_changes(spark, logged, DAILY, feed, keep) > 0
        assert drain_changes(spark, logged, DAILY, feed, keep) == 0
    read_table(spark, logged, schemas.RAW_STAGING).count()
    jobs.run_analytics(spark, logged)
    overwrite_table(read_table(spark, logged, DAILY).filter("index_name = 'a'"), logged, DAILY)
    drain_changes(spark, logged, DAILY, feed, keep)
    for spec in LOGGED:
        same_as_table(spark, logged, spec)
    assert len(set(tokens)) == len(tokens)
    drained = [x for batch in batches for x in batch]
    assert plain(drained) == plain(change_log(spark, logged, DAILY).read().collect())
    assert {x.op for x in drained} == {"insert", "update", "delete"}


@pytest.mark.parametrize("dies_at", ["replace", "publish", "discard"])
def test_an_upsert_that_dies_is_noted_once(spark, logged, monkeypatch, dies_at):
    upsert_table(daily(spark, (1, 1, "a", 1.), (2, 1, "b", 2.)), logged, DAILY, "one")

    def lost(*args):
        raise RuntimeError("lost")

    place, name = {"replace": (tables, "_replace"), "publish": (ChangeLog, "publish"), "discard": (tables, "discard")}[dies_at]
    rows = daily(spark, (1, 1, "a", 9.), (3, 1, "c", 3.))
    with monkeypatch.context() as broken:
        broken.setattr(place, name, lost)
        with pytest.raises(RuntimeError):
            upsert_table(rows, logged, DAILY, "two")
    spark.catalog.refreshTable(tables.stored_table(spark, logged, DAILY))
    for _ in range(2):
        upsert_table(rows, logged, DAILY, "two")
        assert list(change_log(spark, logged, DAILY).published().items()) == [("one", 1), ("two", 2)]
        same_as_table(spark, logged, DAILY)


@pytest.mark.parametrize("dies_at", ["switch", "publish"])
def test_a_rebuild_that_dies_is_settled_by_the_next_writer(spark, logged, monkeypatch, dies_at):
    upsert_table(daily(spark, (1, 1, "a", 1.), (2, 1, "b", 2.)), logged, DAILY)

    def lost(*args):
        raise RuntimeError("lost")

    place, name = {"switch": (tables, "_switch"), "publish": (ChangeLog, "publish")}[dies_at]
    with monkeypatch.context() as broken:
        broken.setattr(place, name, lost)
        with pytest.raises(RuntimeError):
            overwrite_table(daily(spark, (1, 1, "a", 4.)), logged, DAILY)
    upsert_table(daily(spark, (4, 1, "d", 5.)), logged, DAILY)
    log = change_log(spark, logged, DAILY)
    made = [t.startswith(REBUILD) for t in log.published()]
    assert made == ([False, True, False] if dies_at == "publish" else [False, False])
    same_as_table(spark, logged, DAILY)


def test_a_batch_that_dies_comes_again(spark, logged, scratch):
    feed = scratch("feed")
    assert drain_changes(spark, logged, DAILY, feed, lambda changes, token: None) == 0
    for month in (1, 2, 3):
        upsert_table(daily(spark, (month, 1, "a", float(month))), logged, DAILY)
    got = []

    def dies(changes, token):
        got.append((token, ops(changes)))
        if len(got) == 2:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        drain_changes(spark, logged, DAILY, feed, dies, versions_per_batch=2)
    assert drain_changes(spark, logged, DAILY, feed, dies, versions_per_batch=2) == 1
    assert got[1] == got[2] and [len(rows) for _, rows in got] == [2, 1, 1]


def test_a_table_without_versions_logs_no_rebuild(spark, logged):
    name = logged.name(DAILY)
    spark.sql(f"DROP VIEW {name}")
    tables._create(spark, name, DAILY)
    upsert_table(daily(spark, (1, 1, "a", 1.)), logged, DAILY)
    with pytest.raises(ValueError, match="no versions"):
        overwrite_table(daily(spark, (1, 1, "a", 2.)), logged, DAILY)
    same_as_table(spark, logged, DAILY)
