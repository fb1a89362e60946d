"""Rows that wait for their day, and landed files that are corrected in place."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from pricebeam import schemas
from pricebeam.plans import jobs
from pricebeam.sources import tables
from pricebeam.sources.tables import read_table
from pricebeam.streaming import refresh
from pricebeam.streaming.pending import PendingKeys
from pricebeam.streaming.refresh import NO_NEW_DATA, load_raw_data, update_daily_index_metrics
from test_jobs import DERIVED, contents, land, series

D = dt.date
HEADER = "value,date,index,daily_return,monthly_return\n"


def days(spark, layers):
    return read_table(spark, layers, schemas.DAILY_METRICS).count()


def same_as_rebuild(spark, layers, as_of):
    """The derived tables hold what a rebuild of the rows up to `as_of` gives."""
    incremental = {spec: contents(spark, layers, spec) for spec in DERIVED if spec is not schemas.HARMONIZED}
    late = read_table(spark, layers, schemas.HARMONIZED).filter(F.col("timestamp").cast("date") > as_of).count()
    assert late == 0
    jobs.run_analytics(spark, layers)
    for spec, rows in incremental.items():
        assert rows == contents(spark, layers, spec), spec.name


def test_waiting_rows_are_derived_without_a_new_file(spark, layers, scratch):
    landing, load, update = scratch("landing"), scratch("load"), scratch("update")
    rows = series(spark, 50, "a")
    land(rows, landing, "s")
    load_raw_data(spark, layers, f"{landing}/*", load)
    update_daily_index_metrics(spark, layers, update, D(2024, 1, 31))
    assert days(spark, layers) == rows.filter("date <= '2024-01-31'").count()
    waiting = PendingKeys(spark, layers).waiting()
    assert waiting.count() == rows.filter("date > '2024-01-31'").count()
    done = update_daily_index_metrics(spark, layers, update, D(2024, 2, 29))
    assert done.status == "updated" and done.rows["batches"] == 0
    assert days(spark, layers) == rows.count() == done.rows["derived"] + rows.filter("date <= '2024-01-31'").count()
    assert update_daily_index_metrics(spark, layers, update, D(2024, 2, 29)).status == NO_NEW_DATA
    same_as_rebuild(spark, layers, D(2024, 2, 29))


def test_another_series_that_is_further_hides_nothing(spark, layers, scratch):
    """Series a is derived to the end; b comes under an earlier as_of, then the day moves on, twice."""
    landing, load, update = scratch("landing"), scratch("load"), scratch("update")
    a, b = series(spark, 60, "a"), series(spark, 60, "a", seed=9).withColumn("index_name", F.lit("b"))
    for label, rows, as_of in (("a", a, D(2024, 3, 31)), ("b", b, D(2024, 1, 31))):
        land(rows, landing, label)
        load_raw_data(spark, layers, f"{landing}/*", load)
        update_daily_index_metrics(spark, layers, update, as_of)
    assert days(spark, layers) == a.count() + b.filter("date <= '2024-01-31'").count()
    update_daily_index_metrics(spark, layers, update, D(2024, 2, 10))
    assert days(spark, layers) == a.count() + b.filter("date <= '2024-02-10'").count()
    update_daily_index_metrics(spark, layers, update, D(2024, 3, 31))
    same_as_rebuild(spark, layers, D(2024, 3, 31))


@pytest.mark.parametrize("more", [False, True])
def test_a_derivation_that_dies_is_finished(spark, layers, scratch, monkeypatch, more):
    """It dies while waiting rows are derived; with `more`, corrected rows come before the next run."""
    landing, load, update = scratch("landing"), scratch("load"), scratch("update")
    rows = series(spark, 60, "a")
    land(rows, landing, "s")
    load_raw_data(spark, layers, f"{landing}/*", load)
    update_daily_index_metrics(spark, layers, update, D(2024, 1, 20))
    write = tables.upsert_table

    def crash(source, made, spec, token=None, unique=False):
        if spec is schemas.WEEKLY_PERFORMANCE:
            raise RuntimeError("lost")
        write(source, made, spec, token, unique)

    monkeypatch.setattr(tables, "upsert_table", crash)
    with pytest.raises(RuntimeError):
        update_daily_index_metrics(spark, layers, update, D(2024, 3, 31))
    monkeypatch.setattr(tables, "upsert_table", write)
    if more:
        land(rows.filter("day(date) = 7").withColumn("index_value", F.lit(77.0)), landing, "t")
        load_raw_data(spark, layers, f"{landing}/*", load)
    update_daily_index_metrics(spark, layers, update, D(2024, 3, 31))
    assert PendingKeys(spark, layers).waiting().isEmpty()
    same_as_rebuild(spark, layers, D(2024, 3, 31))


def put(path, text, age):
    path.write_text(HEADER + text)
    now = time.time() - age
    os.utime(path, (now, now))


def ledger(spark, layers):
    return sorted((x.file_name.rsplit("/", 1)[1], x.good_rows, x.bad_rows)
                  for x in read_table(spark, layers, schemas.RAW_LOADS).collect())


def test_a_file_replaced_in_place_is_loaded_as_newer(spark, layers, scratch, tmp_path):
    load, update = scratch("load"), scratch("update")
    put(tmp_path / "a 1.csv", "1.5,2024-01-02,DOW,,\n2.5,2024-01-03,DOW,,\n", 500)
    put(tmp_path / "b.csv", "9.5,2024-01-02,SP,,\nx,2024-01-03,SP,,\n", 400)
    put(tmp_path / "c.csv", "", 300)
    assert load_raw_data(spark, layers, str(tmp_path), load).rows == {"loads": 1, "replaced": 0}
    assert ledger(spark, layers) == [("a%201.csv", 2, 0), ("b.csv", 1, 1), ("c.csv", 0, 0)]
    update_daily_index_metrics(spark, layers, update, D(2024, 6, 1))
    put(tmp_path / "a 1.csv", "1.5,2024-01-02,DOW,,\n7.5,2024-01-03,DOW,,\n", 200)   # as long as before
    put(tmp_path / "c.csv", "3.5,2024-01-02,NEW,,\n", 100)
    done = load_raw_data(spark, layers, str(tmp_path), load)
    assert done.status == "loaded" and done.rows == {"loads": 1, "replaced": 2}
    assert load_raw_data(spark, layers, str(tmp_path), load).status == NO_NEW_DATA
    update_daily_index_metrics(spark, layers, update, D(2024, 6, 1))
    daily = {(x.index_name, x.date.day): x.index_value for x in read_table(spark, layers, schemas.DAILY_METRICS).collect()}
    assert daily == {("DOW", 2): 1.5, ("DOW", 3): 7.5, ("SP", 2): 9.5, ("NEW", 2): 3.5}
    good, bad = (read_table(spark, layers, schemas.RAW_LOADS).agg(F.sum(c)).first()[0] for c in ("good_rows", "bad_rows"))
    assert good == read_table(spark, layers, schemas.RAW_STAGING).count()
    assert bad == read_table(spark, layers, schemas.RAW_QUARANTINE).count()


def test_a_replacing_load_that_dies_is_repeated(spark, layers, scratch, tmp_path, monkeypatch):
    load = scratch("load")
    put(tmp_path / "a.csv", "1.5,2024-01-02,DOW,,\n", 500)
    load_raw_data(spark, layers, str(tmp_path), load)
    put(tmp_path / "a.csv", "2.5,2024-01-02,DOW,,\nx,2024-01-02,DOW,,\n", 200)
    write = refresh.enter
    monkeypatch.setattr(refresh, "enter", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        load_raw_data(spark, layers, str(tmp_path), load)
    monkeypatch.setattr(refresh, "enter", write)
    load_raw_data(spark, layers, str(tmp_path), load)
    assert sorted(x.index_value for x in read_table(spark, layers, schemas.RAW_STAGING).collect()) == [1.5, 2.5]
    assert read_table(spark, layers, schemas.RAW_QUARANTINE).count() == 1


def test_nothing_landed(spark, layers, scratch, tmp_path):
    assert load_raw_data(spark, layers, str(tmp_path), scratch("load")).status == NO_NEW_DATA
