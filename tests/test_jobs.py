import datetime as dt
import random

import pytest
from pyspark.sql import Window, functions as F

from pricebeam import schemas
from pricebeam.functions import with_returns
from pricebeam.plans import jobs, views
from pricebeam.plans.harmonize import harmonize
from pricebeam.sources import tables
from pricebeam.sources.tables import overwrite_table, read_table
from pricebeam.streaming import refresh
from pricebeam.streaming.refresh import NO_NEW_DATA, load_raw_data, update_daily_index_metrics
from pricebeam.streaming.weekly import weekly_average_stream

D = dt.date
DERIVED = (schemas.HARMONIZED, schemas.DAILY_METRICS, schemas.WEEKLY_METRICS,
           schemas.MONTHLY_METRICS, schemas.DAILY_PERFORMANCE, schemas.WEEKLY_PERFORMANCE)


def contents(spark, layers, spec):
    def plain(v):
        return round(v, 9) if isinstance(v, float) else v

    return sorted((tuple(plain(v) for v in r) for r in read_table(spark, layers, spec).collect()), key=repr)


def series(spark, days=150, names="ab", seed=3):
    """Daily prices with gaps in the dates and some missing prices, with their returns."""
    rng = random.Random(seed)
    data = [(D(2024, 1, 1) + dt.timedelta(days=i), n, None if rng.random() < .05 else rng.uniform(50, 150))
            for n in names for i in range(days) if rng.random() < (.9 if n == "a" else .2)]
    df = spark.createDataFrame(data, "date date, index_name string, index_value double")
    window = Window.partitionBy("index_name").orderBy("date")
    return with_returns(df, window).select(*schemas.RAW_VALUE_COLUMNS)


def land(df, landing, label):
    df.toDF(*schemas.LANDED_CSV_COLUMNS).coalesce(1).write.option("header", True).csv(f"{landing}/{label}")


def test_load_once(spark, layers, scratch):
    landing, checkpoint = scratch("landing"), scratch("load")
    rows = series(spark)
    land(rows.filter("date < '2024-02-01'"), landing, "one")
    first = load_raw_data(spark, layers, f"{landing}/*", checkpoint)
    assert first.rows["loads"] == 1
    again = load_raw_data(spark, layers, f"{landing}/*", checkpoint)
    assert again.status == NO_NEW_DATA and again.rows["loads"] == 0
    land(rows.filter("date >= '2024-02-01'"), landing, "two")
    load_raw_data(spark, layers, f"{landing}/*", checkpoint)
    raw = read_table(spark, layers, schemas.RAW_STAGING)
    assert raw.count() == rows.count() and raw.filter("load_timestamp IS NULL").count() == 0
    assert raw.select("load_timestamp").distinct().count() == 2


def test_a_large_load_in_batches(spark, layers, scratch, tmp_path):
    for day in (2, 3, 4):
        (tmp_path / f"{day}.csv").write_text(
            f"value,date,index,daily_return,monthly_return\n1.5,2024-01-0{day},DOW,,\n")
    done = load_raw_data(spark, layers, str(tmp_path), scratch("load"), files_per_batch=1)
    assert done.rows["loads"] == 3
    assert spark.table(layers.name(schemas.RAW_STAGING)).select("load_id").distinct().count() == 3


def test_bad_rows_are_set_aside(spark, layers, scratch, tmp_path):
    (tmp_path / "a.csv").write_text("value,date,index,daily_return,monthly_return\n"
                                    "1.5,2024-01-02,DOW,,\nx,2024-01-02,DOW,,\n1.5,2024-01-02\n")
    load_raw_data(spark, layers, str(tmp_path), scratch("load"))
    assert read_table(spark, layers, schemas.RAW_STAGING).count() == 1
    assert read_table(spark, layers, schemas.RAW_QUARANTINE).count() == 2


def test_strict_load_keeps_nothing_of_a_bad_load(spark, layers, tmp_path):
    (tmp_path / "a.csv").write_text("value,date,index,daily_return,monthly_return\n"
                                    "1.5,2024-01-02,DOW,,\nx,2024-01-02,DOW,,\n")
    with pytest.raises(Exception, match="bad row"):
        jobs.load_strict(spark, layers, str(tmp_path), "l1")
    assert read_table(spark, layers, schemas.RAW_STAGING).count() == 0


def test_local_frame_load(spark, layers):
    import pandas as pd

    frame = pd.DataFrame({"index_value": [1.0, 2.0], "date": [D(2024, 1, 2), None],
                          "index_name": ["DOW", "DOW"], "daily_return": [0.5, 0.5],
                          "monthly_return": [0.1, 0.1]})
    jobs.load_frame(spark.createDataFrame(frame, schemas.RAW_VALUES), layers, "l1")
    assert read_table(spark, layers, schemas.RAW_STAGING).count() == 1
    assert read_table(spark, layers, schemas.RAW_QUARANTINE).first().reason == "missing key"


def test_harmonize_keeps_the_newest_load(spark):
    rows = [(1.0, D(2024, 1, 2), "a", None, None, 1), (2.0, D(2024, 1, 2), "a", None, None, 2),
            (2.0, D(2024, 1, 2), "a", None, None, 2)]
    raw = spark.createDataFrame(
        rows, "index_value double, date date, index_name string, daily_return double, "
              "monthly_return double, n int")
    out = harmonize(raw, ("n",)).collect()
    assert len(out) == 1 and out[0].value == 2.0 and out[0].timestamp == dt.datetime(2024, 1, 2)


def test_incremental_equals_full(spark, layers, scratch):
    """Late rows, corrections and a second landing of old rows, in four steps."""
    landing, load, update = scratch("landing"), scratch("load"), scratch("update")
    rows = series(spark).withColumn("h", F.abs(F.hash("date", "index_name")) % 20)
    late = F.col("h") == 0
    corrected = F.col("h") == 1
    wrong = rows.withColumn("index_value", F.when(corrected, F.lit(1.0)).otherwise(F.col("index_value")))
    steps = [wrong.filter(~late & (F.col("date") < "2024-03-10")),
             wrong.filter(~late & F.col("date").between("2024-03-01", "2024-04-20")),
             rows.filter(late | corrected),
             rows.filter((F.col("date") > "2024-04-20") | (F.month("date") == 2))]
    for i, step in enumerate(steps):
        land(step.drop("h"), landing, f"s{i}")
        load_raw_data(spark, layers, f"{landing}/*", load)
        result = update_daily_index_metrics(spark, layers, update, D(2024, 6, 1))
        assert result.rows["batches"] == 1
    assert update_daily_index_metrics(spark, layers, update).status == NO_NEW_DATA
    incremental = {spec: contents(spark, layers, spec) for spec in DERIVED}
    jobs.run_harmonization(spark, layers)
    jobs.run_analytics(spark, layers)
    for spec in DERIVED:
        assert incremental[spec] == contents(spark, layers, spec), spec.name
    assert len(incremental[schemas.HARMONIZED]) == rows.count()


def test_refresh_retries_a_failed_batch(spark, layers, scratch, monkeypatch):
    landing, load, update = scratch("landing"), scratch("load"), scratch("update")
    land(series(spark, 60), landing, "s")
    load_raw_data(spark, layers, f"{landing}/*", load)
    write = tables.upsert_table

    def crash(source, made, spec, token=None):
        if spec is schemas.WEEKLY_METRICS:
            raise RuntimeError("lost")
        write(source, made, spec, token)

    monkeypatch.setattr(tables, "upsert_table", crash)
    with pytest.raises(Exception):
        update_daily_index_metrics(spark, layers, update)
    monkeypatch.setattr(tables, "upsert_table", write)
    assert update_daily_index_metrics(spark, layers, update).rows["batches"] == 1
    incremental = {spec: contents(spark, layers, spec) for spec in DERIVED}
    jobs.run_harmonization(spark, layers)
    jobs.run_analytics(spark, layers)
    for spec in DERIVED:
        assert incremental[spec] == contents(spark, layers, spec), spec.name


def test_strict_refresh_uses_fixed_lookbacks(spark, layers, scratch):
    landing, load, update = scratch("landing"), scratch("load"), scratch("update")
    land(series(spark, 120, "a"), landing, "s")
    load_raw_data(spark, layers, f"{landing}/*", load)
    as_of = D(2024, 4, 16)
    update_daily_index_metrics(spark, layers, update, as_of, strict_reference=True)
    days = [r.date for r in read_table(spark, layers, schemas.DAILY_PERFORMANCE).collect()]
    assert min(days) >= as_of - dt.timedelta(days=30) and max(days) <= as_of
    assert {r.month for r in read_table(spark, layers, schemas.MONTHLY_METRICS).collect()} == {D(2024, 4, 1)}
    first = read_table(spark, layers, schemas.DAILY_PERFORMANCE).orderBy("date").first()
    assert first.volatility == 0.0


def test_late_rows_reach_far_back_for_sparse_series(spark, layers):
    """A series with one row in forty days needs years of history for a whole frame."""
    data = [(D(2020, 1, 1) + dt.timedelta(days=40 * i), "sparse", 100.0 + i * i % 17) for i in range(40)]
    df = spark.createDataFrame(data, "date date, index_name string, index_value double")
    raw = with_returns(df, Window.partitionBy("index_name").orderBy("date"))
    overwrite_table(harmonize(raw), layers, schemas.HARMONIZED)
    changed = raw.orderBy(F.desc("date")).limit(1).select("date", "index_name")
    last = data[-1][0]
    stored = spark.table(layers.name(schemas.HARMONIZED))
    found = refresh.affected_daily_performance(stored, changed, last.replace(day=1)).collect()
    jobs.run_analytics(spark, layers)
    full = read_table(spark, layers, schemas.DAILY_PERFORMANCE).filter(F.col("date") == last).collect()
    assert found == full


def test_end_to_end(spark, layers, scratch):
    path = scratch("series")
    rows = [("SP500", D(2024, 1, 1) + dt.timedelta(days=i), 100.0 + i) for i in range(60)]
    rows += [("DJIA", D(2024, 1, 1) + dt.timedelta(days=i), 200.0 + i % 7) for i in range(60)]
    spark.createDataFrame(rows, "series_id string, date date, value double").write.partitionBy(
        "series_id").option("header", True).csv(path)
    landing, load = scratch("landing"), scratch("load")
    for _ in range(2):
        result = jobs.end_to_end(spark, layers, path, landing, load, D(2024, 1, 10), D(2024, 2, 20))
    assert result.status == "complete"
    assert result.rows["index_harmonized"] == 2 * 42 == result.rows["daily_index_metrics"]
    assert result.rows["index_staging"] == 4 * 42
    names = {r.index_name for r in read_table(spark, layers, schemas.DAILY_METRICS).collect()}
    assert names == {"S&P500", "DOW"}
    flat = read_table(spark, layers, schemas.HARMONIZED_VOLATILITY)
    assert {(r.normalized_value, r.volatility) for r in flat.collect()} == {(1.0, 0.0)}
    assert views.preview_table(spark, layers, "analytics", "daily_index_metrics", 5).count() == 5
    with pytest.raises(ValueError):
        views.preview_table(spark, layers, "analytics", "daily_index_metrics; DROP TABLE x")


TICKS = "ts timestamp, index_name string, index_value double, event_id long"


def test_weekly_stream(spark, scratch):
    """Two deliveries with a repeated tick; a tick behind the watermark is left out."""
    source, out, checkpoint = scratch("ticks"), scratch("out"), scratch("checkpoint")

    def deliver(*rows):
        spark.createDataFrame([(dt.datetime.fromisoformat(t), "a", v, i) for t, v, i in rows], TICKS
                              ).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(TICKS).parquet(source)
        query = weekly_average_stream(stream).writeStream.format("parquet").option("path", out).option(
            "checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()

    deliver(("2024-06-10T00:00", 1.0, 1), ("2024-06-16T23:59", 3.0, 2), ("2024-06-16T23:59", 3.0, 2))
    deliver(("2024-06-16T23:59", 3.0, 2), ("2024-06-16T12:00", 5.0, 3), ("2024-06-20T00:00", 7.0, 4))
    deliver(("2024-06-11T00:00", 99.0, 5), ("2024-06-26T00:00", 7.0, 6))
    found = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert found == [(D(2024, 6, 10), "a", 3.0), (D(2024, 6, 17), "a", 7.0)]


def test_command_line_jobs(spark, layers, scratch):
    from pricebeam.cli import parser, run

    landing, checkpoint = scratch("landing"), scratch("checkpoint")
    land(series(spark, 40), landing, "s")

    def job(name):
        return run(spark, parser().parse_args([
            name, "--prefix", layers.prefix, "--root", layers.root, "--landing", landing,
            "--checkpoint", checkpoint, "--as-of", "2024-06-01"])).status

    statuses = [job(n) for n in ("create", "load", "refresh", "refresh", "harmonize", "analytics")]
    assert statuses == ["created", "loaded", "updated", NO_NEW_DATA, "harmonized", "analytics rebuilt"]
    assert contents(spark, layers, schemas.DAILY_METRICS)
