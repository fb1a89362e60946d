"""What a load must not do silently: skip old files, take damaged fields, prefer older rows."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from pricebeam import schemas
from pricebeam.operators.changes import row_changes, snapshot_changes
from pricebeam.operators.comparison import return_correlation
from pricebeam.operators.series import tag_series, unlisted_series
from pricebeam.operators.sliced import over_series
from pricebeam.operators.upsert import DuplicateKeyError
from pricebeam.sources.files import bad_rows, classify, good_rows, pull_series, read_csv_text, read_json, read_json_text
from pricebeam.sources.tables import read_table
from pricebeam.streaming.refresh import NO_NEW_DATA, load_raw_data, update_daily_index_metrics

HEADER = "value,date,index,daily_return,monthly_return\n"


def land(folder, name, *lines, age_days=0):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}"
    with open(path, "w") as f:
        f.write(HEADER + "".join(f"{x}\n" for x in lines))
    then = time.time() - age_days * 86400
    os.utime(path, (then, then))


def test_files_of_any_date_are_loaded(spark, layers, scratch):
    landing, checkpoint = scratch("landing"), scratch("load")
    land(landing, "a.csv", "1.0,2024-01-02,X,,")
    load_raw_data(spark, layers, landing, checkpoint)
    land(landing, "b.csv", "2.0,2024-01-03,X,,", age_days=10)
    land(landing, "c.csv", "3.0,2024-01-04,X,,", age_days=4000)
    load_raw_data(spark, layers, landing, checkpoint)
    assert load_raw_data(spark, layers, landing, checkpoint).status == NO_NEW_DATA
    rows = read_table(spark, layers, schemas.RAW_STAGING).collect()
    assert sorted(x.index_value for x in rows) == [1.0, 2.0, 3.0]
    assert len({x.file_name for x in rows}) == 3


def test_newest_file_wins_and_as_of_holds(spark, layers, scratch):
    landing, load, update = scratch("landing"), scratch("load"), scratch("update")
    land(landing, "new.csv", "5.0,2024-01-02,X,,")
    land(landing, "old.csv", "9.0,2024-01-02,X,,", "7.0,2024-01-20,X,,", "8.0,2024-01-25,X,,", age_days=2)
    load_raw_data(spark, layers, landing, load)
    update_daily_index_metrics(spark, layers, update, dt.date(2024, 1, 20))

    def daily():
        return sorted((str(x.date), x.index_value) for x in read_table(spark, layers, schemas.DAILY_METRICS).collect())

    assert daily() == [("2024-01-02", 5.0), ("2024-01-20", 7.0)]
    assert read_table(spark, layers, schemas.HARMONIZED).count() == 3
    for spec in (schemas.DAILY_PERFORMANCE, schemas.HARMONIZED_VOLATILITY):
        assert read_table(spark, layers, spec).count() == 2
    # Later days follow once as_of passes them, with whatever else is new in the same month.
    land(landing, "more.csv", "6.0,2024-01-22,X,,")
    load_raw_data(spark, layers, landing, load)
    update_daily_index_metrics(spark, layers, update, dt.date(2024, 1, 31))
    assert daily() == [("2024-01-02", 5.0), ("2024-01-20", 7.0), ("2024-01-22", 6.0), ("2024-01-25", 8.0)]
    assert read_table(spark, layers, schemas.HARMONIZED_VOLATILITY).count() == 4


@pytest.mark.parametrize("line,reason", [
    ("1.0,2024-01,X,,", "date"), ("1.0,2024,X,,", "date"), ("1.0,2024-01-01x,X,,", "date"), ("10.5d,2024-01-01,X,,", "index_value"),
    ("Infinity,2024-01-01,X,,", "index_value"), ("1e999,2024-01-01,X,,", "index_value"), ("1.0,2024-13-01,X,,", "date"),
    ("1.0,2024-01-01", "field count"), ("1.0,2024-01-01,X,,,", "field count"),
])
def test_damaged_fields_are_set_aside(spark, scratch, line, reason):
    folder = scratch("csv")
    land(folder, "a.csv", line, "-1.5e2,2024-01-01,X,,NaN")
    rows = classify(read_csv_text(spark, folder))
    assert [x.reason for x in bad_rows(rows).collect()] == [reason]
    assert [(x.index_value, x.monthly_return) for x in good_rows(rows).collect()] == [(-150.0, None)]


@pytest.mark.parametrize("line", ["2024-01-03", "2024-01-04,3.0,9,9", "2024-01,4", "2024-01-05,4f", "2024-01-05,inf"])
def test_pulls_fail_on_damaged_lines(spark, scratch, line):
    folder = scratch("series")
    os.makedirs(f"{folder}/series_id=A")
    with open(f"{folder}/series_id=A/a.csv", "w") as f:
        f.write(f"date,value\n2024-01-02,.\n{line}\n")
    with pytest.raises(Exception, match="bad series row"):
        pull_series(spark, folder, F.lit(dt.date(2000, 1, 1)), F.lit(dt.date(2030, 1, 1))).collect()


def test_json_lines(spark, scratch):
    folder = scratch("json")
    os.makedirs(folder)
    with open(f"{folder}/a.json", "w") as f:
        f.write('{"date":"2024-01-02","index_name":"X","index_value":1.5}\n{"date":"2024-01-03","ind\n'
                '{"date":"2024-01-04","index_name":"X","index_value":"x"}\n{"date":"2024-01-05","index_name":"X"}\n')
    rows = classify(read_json_text(spark, folder), schemas.LANDED_JSON)
    assert sorted(x.reason for x in bad_rows(rows).collect()) == ["field count", "index_value"]
    assert sorted(x.index_value or 0 for x in good_rows(rows, schemas.LANDED_JSON).collect()) == [0, 1.5]
    with pytest.raises(Exception, match="bad row"):
        read_json(spark, folder).collect()


def test_stream_reads_a_file_or_a_directory(spark, scratch):
    source, sf_dir = "/root/testdata/sf0.001", scratch("sf")
    for table in ("events", "orders"):
        spark.read.parquet(f"{source}/{table}.parquet").repartition(3).write.parquet(f"{sf_dir}/{table}.parquet")
    stream = queries()["stream_weekly_average"]
    assert sorted(map(tuple, stream(spark, sf_dir).collect())) == sorted(map(tuple, stream(spark, source).collect())) != []


def test_snapshots_with_repeated_keys_have_no_difference(spark):
    one = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(DuplicateKeyError):
        snapshot_changes(one, one.limit(1), ["k"])
    got = sorted(map(tuple, row_changes(one.union(one), one.union(one.limit(0))).collect()))
    assert got == [("a", 1, "delete"), ("a", 2, "delete")]


def test_no_series_is_left_out_unseen(spark):
    rows = [(dt.date(2024, 1, d), n, float(d * k)) for d in range(1, 9) for n, k in (("x", 1), ("y", -2), ("z", 3))]
    df = spark.createDataFrame(rows, "date date, index_name string, daily_return double")
    assert {(x.index_a, x.index_b): round(x.correlation, 6) for x in return_correlation(df).collect()} == {
        ("x", "y"): -1.0, ("x", "z"): 1.0, ("y", "z"): -1.0}
    series = df.withColumnRenamed("index_name", "series_id")
    assert tag_series(series, {"x": "X"}).count() == 8
    assert sorted(map(tuple, unlisted_series(series, {"x": "X"}).collect())) == [("y", 8), ("z", 8)]


@pytest.mark.parametrize("limit", [10, 1000])
def test_ties_fall_alike_on_both_ways(spark, limit):
    rows = [("s", i // 7, (i * 37) % 11, i) for i in range(300)] + [("t", 1, 1, 1)]
    df = spark.createDataFrame(rows, "series string, day int, v int, w int")
    result = over_series(df, ["series"], ["day"], 29,
                         lambda d, w: d.withColumn("before", F.first("w").over(w.rowsBetween(-29, 0))), max_rows=limit)
    got = {(x.series, x.day, x.v, x.w): x.before for x in result.collect()}
    ordered = sorted(rows)
    series = [x for x in ordered if x[0] == "s"]
    assert got == {**{x: series[max(0, i - 29)][3] for i, x in enumerate(series)}, ("t", 1, 1, 1): 1}
