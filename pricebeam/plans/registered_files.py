"""Registered queries that go through files, tables and streams.

Their inputs are written by Spark from the given tables into the shared folder.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricebeam import schemas
from pricebeam.operators.changes import replayed
from pricebeam.plans.registered import (
    PRIORITY_NAMES,
    P,
    frame_volatility_sql,
    r6,
    registered,
    weekly_performance_sql,
)
from pricebeam.plans.jobs import end_to_end, ingest, load_frame, run_analytics, run_harmonization
from pricebeam.session import on_filesystem, scratch_path
from pricebeam.sources.adapters import (
    AS_OF,
    daily_series,
    daily_series_with_gaps,
    event_ticks,
    raw_series,
    read,
)
from pricebeam.sources.export import export_csv
from pricebeam.sources.files import (
    FILE_AGE,
    bad_rows,
    classify,
    good_rows,
    pull_series,
    read_csv_strict,
    read_csv_text,
    read_json,
    read_json_text,
)
from pricebeam.sources.tables import Layers, create_layers, overwrite_table, read_table, upsert_table
from pricebeam.streaming.change_feed import drain_changes
from pricebeam.streaming.refresh import load_raw_data, update_daily_index_metrics
from pricebeam.streaming.weekly import weekly_average_stream
from pricebeam.streaming.weekly_corrected import CorrectedWeeks

CSV_HEADER = ",".join(schemas.LANDED_CSV_COLUMNS)


def _landed_columns(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed({"index_value": "value", "index_name": "index"})


def _write_lines(lines: DataFrame, path: str) -> None:
    """CSV text as given, one header line per file. The separator does not occur in the text, so
    nothing gets quoted."""
    lines.toDF(CSV_HEADER).write.option("header", True).option("sep", "\u0001").csv(path)


def _damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The series as CSV lines. By price: the lowest have a bad number (half of them one that a cast would
    take), the next a date cut short, the next too few fields, the next too many, and the highest a null
    token for the daily return."""
    raw = raw_series(spark, sf_dir)
    price = F.col("index_value")

    def text(column):
        return F.coalesce(F.col(column).cast("string"), F.lit(""))

    value = F.when(price < 10_000, "10.5d").when(price < 30_000, "bad").otherwise(text("index_value"))
    date = F.when(price.between(30_000, 49_999.995), F.substring(text("date"), 1, 7)).otherwise(text("date"))
    daily = F.when(price >= 400_000, "NULL").otherwise(text("daily_return"))
    start = F.concat_ws(",", value, date, text("index_name"), daily)
    whole = F.concat_ws(",", start, text("monthly_return"))
    line = F.when(price.between(50_000, 100_000), start).when(
        price.between(100_000, 150_000), F.concat(whole, F.lit(",extra"))).otherwise(whole)
    return raw.select(line.alias("line"))


def _landed_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "damaged")
    _write_lines(_damaged_lines(spark, sf_dir), path)
    return classify(read_csv_text(spark, path))


RAW_SQL_COLUMNS = """date, index_name, index_value, round(daily_return, 6) AS daily_return,
  round(monthly_return, 6) AS monthly_return"""


def _rounded_raw(df: DataFrame) -> DataFrame:
    return df.select("date", "index_name", "index_value", r6("daily_return"), r6("monthly_return"))


@registered("csv_load_tolerant", f"""WITH {P}
SELECT date, index_name, index_value,
  round(CASE WHEN index_value < 400000 THEN daily_return END, 6) AS daily_return,
  round(monthly_return, 6) AS monthly_return
FROM pr WHERE index_value > 150000""")
def csv_load_tolerant(spark, sf_dir):
    return _rounded_raw(good_rows(_landed_damaged(spark, sf_dir)))


@registered("csv_quarantine", f"""WITH {P}
SELECT CASE WHEN index_value >= 30000 AND index_value < 50000 THEN strftime(date, '%Y-%m')
    ELSE strftime(date, '%Y-%m-%d') END AS date, index_name,
  CASE WHEN index_value < 30000 THEN 'index_value' WHEN index_value < 50000 THEN 'date'
    ELSE 'field count' END AS reason
FROM pr WHERE index_value <= 150000""")
def csv_quarantine(spark, sf_dir):
    return bad_rows(_landed_damaged(spark, sf_dir)).select("date", "index_name", "reason")


@registered("csv_export_roundtrip", f"WITH {P} SELECT {RAW_SQL_COLUMNS} FROM pr")
def csv_export_roundtrip(spark, sf_dir):
    landed = _landed_columns(raw_series(spark, sf_dir))
    export = export_csv(landed, scratch_path(spark, "export"), AS_OF)
    return _rounded_raw(read_csv_strict(spark, export.path))


@registered("json_load", f"WITH {P} SELECT date, index_name, index_value FROM p0")
def json_load(spark, sf_dir):
    path = scratch_path(spark, "json")
    daily_series_with_gaps(spark, sf_dir).drop("seq").write.json(path)
    return read_json(spark, path)


@registered("json_quarantine", f"""WITH {P}
SELECT CASE WHEN index_value < 20000 THEN strftime(date, '%Y') WHEN index_value >= 40000 THEN strftime(date, '%Y-%m-%d') END AS date,
  CASE WHEN index_value < 20000 OR index_value >= 40000 THEN index_name END AS index_name,
  CASE WHEN index_value < 20000 THEN 'date' WHEN index_value < 40000 THEN 'field count' ELSE 'index_value' END AS reason
FROM p WHERE index_value < 60000""")
def json_quarantine(spark, sf_dir):
    """JSON lines of which the cheapest have a date cut short, the next end too early, and the next have
    a word for a number; the others are good."""
    path, price = scratch_path(spark, "json"), F.col("index_value")
    line = F.to_json(F.struct(
        F.when(price < 20_000, F.date_format("date", "yyyy")).otherwise(F.date_format("date", "yyyy-MM-dd")).alias("date"),
        "index_name", F.when(price.between(40_000, 59_999.995), "x").otherwise(price.cast("string")).alias("index_value")))
    cut = F.when((price >= 20_000) & (price < 40_000), F.substring(line, 1, 20)).otherwise(line)
    daily_series(spark, sf_dir).select(cut.alias("value")).write.text(path)
    rows = classify(read_json_text(spark, path), schemas.LANDED_JSON)
    return bad_rows(rows).select("date", "index_name", "reason")


def _write_series_files(spark: SparkSession, sf_dir: str) -> str:
    """One directory of (date, value) files per series."""
    path = scratch_path(spark, "series")
    daily_series(spark, sf_dir).select(
        "date", F.col("index_value").alias("value"), F.col("index_name").alias("series_id"),
    ).write.partitionBy("series_id").option("header", True).csv(path)
    return path


@registered("series_pull", f"""WITH {P}
SELECT date, index_name AS series_id, index_value AS value FROM p
WHERE date BETWEEN DATE '1997-01-01' AND DATE '2001-07-31'""")
def series_pull(spark, sf_dir):
    return pull_series(spark, _write_series_files(spark, sf_dir), F.lit(dt.date(1997, 1, 1)),
                       F.lit(AS_OF))


@registered("ingest_landed", f"""WITH {P},
q AS (SELECT date, index_name, index_value FROM p WHERE date BETWEEN DATE '1997-01-01' AND DATE '2001-07-31')
SELECT date, substr(index_name, 3) AS index_name, index_value,
  round(index_value / lag(index_value, 1) OVER w - 1, 6) AS daily_return,
  round(index_value / lag(index_value, 30) OVER w - 1, 6) AS monthly_return
FROM q WINDOW w AS (PARTITION BY index_name ORDER BY date)""")
def ingest_landed(spark, sf_dir):
    landing = scratch_path(spark, "landing")
    ingest(spark, _write_series_files(spark, sf_dir), landing, dt.date(1997, 1, 1), AS_OF,
           PRIORITY_NAMES)
    return _rounded_raw(read_csv_strict(spark, f"{landing}/*"))


def _fresh_layers(spark: SparkSession) -> Layers:
    """Tables of one query run, stored in the shared folder."""
    layers = Layers(f"run_{uuid.uuid4().hex[:12]}_", scratch_path(spark, "tables"))
    create_layers(spark, layers)
    return layers


def _land(rows: DataFrame, landing: str, label: str) -> None:
    """Land rows with the staging columns as CSV files under their own directory."""
    _landed_columns(rows).select(*schemas.LANDED_CSV_COLUMNS).write.option("header", True).csv(
        f"{landing}/{label}")


@registered("stream_load_once", f"""WITH {P} SELECT {RAW_SQL_COLUMNS} FROM pr""")
def stream_load_once(spark, sf_dir):
    """Two landings and three runs: nothing is loaded twice."""
    layers, landing = _fresh_layers(spark), scratch_path(spark, "landing")
    checkpoint = scratch_path(spark, "load")
    raw = raw_series(spark, sf_dir)
    split = F.col("date") < F.lit(dt.date(1999, 1, 1))
    _land(raw.filter(split), landing, "first")
    load_raw_data(spark, layers, f"{landing}/*", checkpoint)
    _land(raw.filter(~split), landing, "second")
    load_raw_data(spark, layers, f"{landing}/*", checkpoint)
    load_raw_data(spark, layers, f"{landing}/*", checkpoint)
    return _rounded_raw(read_table(spark, layers, schemas.RAW_STAGING))


def _refreshed_in_steps(spark: SparkSession, steps: list[DataFrame]) -> Layers:
    """Land and load each step, refreshing after each."""
    layers, landing = _fresh_layers(spark), scratch_path(spark, "landing")
    load, update = scratch_path(spark, "load"), scratch_path(spark, "update")
    for number, rows in enumerate(steps):
        _land(rows, landing, f"step{number}")
        load_raw_data(spark, layers, f"{landing}/*", load)
        update_daily_index_metrics(spark, layers, update, AS_OF)
    return layers


@registered("stream_fanout", f"""WITH {P}
SELECT date, index_name, index_value, round(daily_return, 6) AS daily_return,
  CAST(date AS TIMESTAMP) AS timestamp, round(monthly_return, 6) AS monthly_return FROM pr
WHERE date <= DATE '2001-07-31' UNION ALL
SELECT date, index_name, NULL, NULL, CAST(date AS TIMESTAMP), round(monthly_return, 6) FROM pr
WHERE date > DATE '2001-07-31'""")
def stream_fanout(spark, sf_dir):
    """Both sinks of the refresh: daily metrics joined to harmonized rows. Only the latter hold days after
    the refresh's date."""
    raw = raw_series(spark, sf_dir)
    layers = _refreshed_in_steps(spark, [raw.filter(F.year("date") < 2001),
                                         raw.filter(F.year("date") >= 2000)])
    daily = read_table(spark, layers, schemas.DAILY_METRICS)
    harmonized = read_table(spark, layers, schemas.HARMONIZED).select(
        "timestamp", "index_name", "monthly_return", F.col("timestamp").cast("date").alias("date"))
    return daily.join(harmonized, ["date", "index_name"], "full_outer").select(
        "date", "index_name", "index_value", r6("daily_return"), "timestamp", r6("monthly_return"))


@registered("incremental_equals_full", f"""WITH {P},
cut AS (SELECT * FROM pr WHERE date <= DATE '2001-07-31'), {frame_volatility_sql(21, "cut")},
{weekly_performance_sql("cut")}
SELECT 'daily_performance' AS table_name, date AS day, index_name, index_value AS a,
  round(daily_return, 6) AS b, volatility AS c FROM vol
UNION ALL SELECT 'weekly_performance', week_start, index_name, round(avg_value, 6),
  round(weekly_return, 6), volatility FROM wp
UNION ALL SELECT 'weekly_index_metrics', date_trunc('week', date)::DATE, index_name,
  round(avg(index_value), 6), round(avg(daily_return), 6), NULL FROM cut GROUP BY 2, 3
UNION ALL SELECT 'monthly_index_metrics', date_trunc('month', date)::DATE, index_name,
  round(max(monthly_return), 6), NULL, NULL FROM cut GROUP BY 2, 3
UNION ALL SELECT 'daily_index_metrics', date, index_name, index_value, round(daily_return, 6), NULL FROM cut
UNION ALL SELECT 'index_harmonized_with_volatility', date, index_name, index_value, 1.0, 0.0 FROM cut""")
def incremental_equals_full(spark, sf_dir):
    """Three refreshes; the last one also brings late rows of earlier years (the lowest prices) and
    rows that were landed before."""
    raw, year = raw_series(spark, sf_dir), F.year("date")
    late = (F.col("index_value") < 10_000) & (year < 2001)
    layers = _refreshed_in_steps(spark, [
        raw.filter(~late & (year < 2000)),
        raw.filter(~late & (year == 2000)),
        raw.filter(late | (year > 2000) | ((year == 2000) & (F.month("date") == 12))),
    ])
    tables = (schemas.DAILY_PERFORMANCE, schemas.WEEKLY_PERFORMANCE, schemas.WEEKLY_METRICS,
              schemas.MONTHLY_METRICS, schemas.DAILY_METRICS, schemas.HARMONIZED_VOLATILITY)
    out = None
    for spec in tables:
        table = read_table(spark, layers, spec)
        if spec == schemas.HARMONIZED_VOLATILITY:
            table = table.select(F.col("timestamp").cast("date").alias("timestamp"), "index_name", "value",
                                 "normalized_value", "volatility")
        values = table.columns[2:] + [None] * (5 - len(table.columns))
        long = table.select(
            F.lit(spec.name).alias("table_name"), F.col(spec.dated_by).alias("day"), "index_name",
            *[r6(v, name) if v else F.lit(None).cast("double").alias(name)
              for v, name in zip(values, "abc")])
        out = long if out is None else out.unionByName(long)
    return out


@registered("read_between_refreshes", f"""WITH {P}
SELECT date, index_name, index_value, round(daily_return, 6) AS daily_return,
  CAST(date AS TIMESTAMP) AS timestamp FROM pr WHERE date <= DATE '2001-07-31'""")
def read_between_refreshes(spark, sf_dir):
    """All tables are read after a refresh in the middle of a month, and again after the month's rest."""
    raw, middle = raw_series(spark, sf_dir), F.lit(dt.date(2001, 7, 16))
    layers, landing = _fresh_layers(spark), scratch_path(spark, "landing")
    load, update = scratch_path(spark, "load"), scratch_path(spark, "update")
    for number, rows in enumerate((raw.filter(F.col("date") < middle), raw.filter(F.col("date") >= middle))):
        _land(rows, landing, f"step{number}")
        load_raw_data(spark, layers, f"{landing}/*", load)
        update_daily_index_metrics(spark, layers, update, AS_OF)
        for spec in schemas.TABLES:
            read_table(spark, layers, spec).foreach(lambda row: None)
    daily = read_table(spark, layers, schemas.DAILY_METRICS)
    harmonized = read_table(spark, layers, schemas.HARMONIZED).select("timestamp", "index_name")
    return daily.join(harmonized, (F.col("timestamp").cast("date") == daily["date"])
                      & (harmonized["index_name"] == daily["index_name"])).select(
        "date", daily["index_name"], "index_value", r6("daily_return"), "timestamp")


@registered("newest_file_wins", f"""WITH {P}
SELECT date, index_name, index_value - CASE WHEN year(date) = 2000 THEN 1000 ELSE 0 END AS index_value
FROM p WHERE date <= DATE '2001-07-31'""")
def newest_file_wins(spark, sf_dir):
    """A correction to lower prices, landed after the prices but loaded in the same batch."""
    raw = raw_series(spark, sf_dir)
    layers, landing = _fresh_layers(spark), scratch_path(spark, "landing")
    _land(raw, landing, "prices")
    _land(raw.filter(F.year("date") == 2000).withColumn("index_value", F.col("index_value") - 1000),
          landing, "correction")
    load_raw_data(spark, layers, f"{landing}/*", scratch_path(spark, "load"))
    update_daily_index_metrics(spark, layers, scratch_path(spark, "update"), AS_OF)
    return read_table(spark, layers, schemas.DAILY_METRICS).select("date", "index_name", "index_value")


@registered("deferred_rows_derived", f"""WITH {P},
cut AS (SELECT * FROM pr WHERE date <= DATE '2001-07-31'), {weekly_performance_sql("cut")}
SELECT 'daily_index_metrics' AS table_name, date AS day, index_name, index_value AS a, round(daily_return, 6) AS b FROM cut
UNION ALL SELECT 'weekly_index_metrics', date_trunc('week', date)::DATE, index_name,
  round(avg(index_value), 6), round(avg(daily_return), 6) FROM cut GROUP BY 2, 3
UNION ALL SELECT 'monthly_index_metrics', date_trunc('month', date)::DATE, index_name, round(max(monthly_return), 6), NULL
  FROM cut GROUP BY 2, 3
UNION ALL SELECT 'weekly_performance', week_start, index_name, round(avg_value, 6), round(weekly_return, 6) FROM wp""")
def deferred_rows_derived(spark, sf_dir):
    """Two series are landed whole and derived up to 1999; the others come while the day goes back to 1997. Then
    the day moves on, with no new file, and all that waited is derived."""
    raw, layers, landing = raw_series(spark, sf_dir), _fresh_layers(spark), scratch_path(spark, "landing")
    load, update = scratch_path(spark, "load"), scratch_path(spark, "update")
    first = F.col("index_name") < "3"
    for label, rows, as_of in (("first", raw.filter(first), dt.date(1999, 6, 30)),
                               ("others", raw.filter(~first), dt.date(1997, 3, 15))):
        _land(rows, landing, label)
        load_raw_data(spark, layers, f"{landing}/*", load)
        update_daily_index_metrics(spark, layers, update, as_of)
    update_daily_index_metrics(spark, layers, update, AS_OF)
    out = None
    for spec in (schemas.DAILY_METRICS, schemas.WEEKLY_METRICS, schemas.MONTHLY_METRICS, schemas.WEEKLY_PERFORMANCE):
        values = [*spec.column_names[2:4], None][:2]
        long = read_table(spark, layers, spec).select(
            F.lit(spec.name).alias("table_name"), F.col(spec.dated_by).alias("day"), "index_name",
            *[r6(v, name) if v else F.lit(None).cast("double").alias(name) for v, name in zip(values, "ab")])
        out = long if out is None else out.unionByName(long)
    return out


def _replace_in_place(rows: DataFrame, landing: str, label: str) -> None:
    """Write rows over the files of a landed directory, part by part, under the files' old names."""
    spark, fresh = rows.sparkSession, scratch_path(rows.sparkSession, "fresh")
    _land(rows, fresh, label)
    files, old = on_filesystem(spark, f"{landing}/{label}")

    def parts(path):
        return {x.getPath().getName()[:10]: x.getPath() for x in files.listStatus(path) if x.getPath().getName().startswith("part-")}

    new = parts(on_filesystem(spark, f"{fresh}/{label}")[1])
    for number, target in parts(old).items():
        files.delete(target, False)
        if number in new:
            files.rename(new[number], target)


@registered("replaced_file_wins", f"""WITH {P}
SELECT date, index_name, index_value - CASE WHEN index_value < 150000 THEN 1000 ELSE 0 END AS index_value
FROM p WHERE date <= DATE '2001-07-31'""")
def replaced_file_wins(spark, sf_dir):
    """Landed files are corrected in place, with other prices; the load takes them as newer files."""
    raw = raw_series(spark, sf_dir)
    layers, landing, load = _fresh_layers(spark), scratch_path(spark, "landing"), scratch_path(spark, "load")
    update = scratch_path(spark, "update")
    wrong = raw.repartition(4, "date", "index_name")
    right = wrong.withColumn("index_value", F.col("index_value") - F.when(F.col("index_value") < 150_000, 1000).otherwise(0))
    _land(wrong, landing, "prices")
    load_raw_data(spark, layers, f"{landing}/*", load)
    update_daily_index_metrics(spark, layers, update, AS_OF)
    _replace_in_place(right, landing, "prices")
    load_raw_data(spark, layers, f"{landing}/*", load)
    update_daily_index_metrics(spark, layers, update, AS_OF)
    return read_table(spark, layers, schemas.DAILY_METRICS).select("date", "index_name", "index_value")


@registered("read_during_overwrite", f"""WITH {P}
SELECT 'before' AS read, date, index_name, index_value FROM p
UNION ALL SELECT 'after', date, index_name, index_value - CASE WHEN year(date) = 2000 THEN 1000 ELSE 0 END FROM p""")
def read_during_overwrite(spark, sf_dir):
    """A reader of the daily metrics begins, a correction is loaded and all tables are rebuilt; the reader gets
    the rows of the version that it began with, a later one those of the rebuild."""
    raw, layers = raw_series(spark, sf_dir), _fresh_layers(spark)
    reads = []
    for read_at, rows in (("before", raw), ("after", raw.filter(F.year("date") == 2000).withColumn(
            "index_value", F.col("index_value") - 1000))):
        load_frame(rows, layers, read_at)
        run_harmonization(spark, layers)
        run_analytics(spark, layers)
        reads.append(read_table(spark, layers, schemas.DAILY_METRICS).select(
            F.lit(read_at).alias("read"), "date", "index_name", "index_value"))
    return reads[0].unionByName(reads[1])


@registered("change_log_replayed", f"""WITH {P},
old AS (SELECT date, index_name, index_value AS v FROM p WHERE date <= DATE '2001-07-31' AND year(date) <> 1999),
mid AS (SELECT date, index_name, index_value - CASE WHEN year(date) = 2000 AND index_value < 150000 THEN 1000 ELSE 0 END AS v
        FROM p WHERE date <= DATE '2001-07-31'),
new AS (SELECT * FROM mid WHERE index_name <> '5-LOW'),
log AS (
  SELECT date, index_name, CAST(NULL AS DOUBLE) AS before, v AS after FROM old
  UNION ALL SELECT m.date, m.index_name, o.v, m.v FROM mid m LEFT JOIN old o ON m.date = o.date AND m.index_name = o.index_name
  WHERE o.v IS DISTINCT FROM m.v
  UNION ALL SELECT date, index_name, v, NULL FROM mid WHERE index_name = '5-LOW')
SELECT CASE WHEN before IS NULL THEN 'insert' WHEN after IS NULL THEN 'delete' ELSE 'update' END AS op, date, index_name,
  before, after FROM log
UNION ALL SELECT 'replayed', date, index_name, NULL, v FROM new""")
def change_log_replayed(spark, sf_dir):
    """Daily metrics come without 1999, then with that year and a correction of the lower prices of 2000, and are
    replaced without one series. A stream drains their log after each; all rows of it, and the table that they
    add up to."""
    spec = schemas.DAILY_METRICS
    rows = raw_series(spark, sf_dir).filter(F.col("date") <= AS_OF).select(*spec.column_names)
    layers = Layers(f"run_{uuid.uuid4().hex[:12]}_", scratch_path(spark, "tables"), (spec.name,))
    create_layers(spark, layers)
    feed, drained, year = scratch_path(spark, "feed"), scratch_path(spark, "drained"), F.year("date")

    def keep(changes, token):
        changes.write.mode("overwrite").parquet(f"{drained}/token={token}")

    lower = F.when((year == 2000) & (F.col("index_value") < 150_000), 1000).otherwise(0)
    for part in (rows.filter(year != 1999),
                 rows.filter(year.isin(1999, 2000)).withColumn("index_value", F.col("index_value") - lower)):
        upsert_table(part, layers, spec)
        drain_changes(spark, layers, spec, feed, keep)
    overwrite_table(read_table(spark, layers, spec).filter("index_name <> '5-LOW'"), layers, spec)
    drain_changes(spark, layers, spec, feed, keep)
    changes = spark.read.parquet(drained)
    row = F.coalesce("before", "after")
    table = replayed(spark.createDataFrame([], spec.columns), changes)
    return changes.select("op", row["date"].alias("date"), row["index_name"].alias("index_name"),
                          F.col("before.index_value").alias("before"), F.col("after.index_value").alias("after")).unionByName(
        table.select(F.lit("replayed").alias("op"), "date", "index_name", F.lit(None).cast("double").alias("before"),
                     F.col("index_value").alias("after")))


@registered("json_staged", f"WITH {P} SELECT date, index_name, index_value FROM p0")
def json_staged(spark, sf_dir):
    """JSON lines loaded into staging like CSV files."""
    layers, landing = _fresh_layers(spark), scratch_path(spark, "landing")
    daily_series_with_gaps(spark, sf_dir).drop("seq").write.json(f"{landing}/first")
    load_raw_data(spark, layers, f"{landing}/*", scratch_path(spark, "load"), kind="json")
    return read_table(spark, layers, schemas.RAW_STAGING).select("date", "index_name", "index_value")


@registered("end_to_end_weekly", f"""WITH {P},
q AS (SELECT date, substr(index_name, 3) AS index_name, index_value,
        index_value / lag(index_value) OVER (PARTITION BY index_name ORDER BY date) - 1 AS r
      FROM p WHERE date BETWEEN DATE '1997-01-01' AND DATE '2001-07-31')
SELECT date_trunc('week', date)::DATE AS week, index_name,
  round(avg(index_value), 6) AS avg_index_value, round(avg(r), 6) AS avg_daily_return
FROM q GROUP BY ALL""")
def end_to_end_weekly(spark, sf_dir):
    layers = Layers(f"run_{uuid.uuid4().hex[:12]}_", scratch_path(spark, "tables"))
    end_to_end(spark, layers, _write_series_files(spark, sf_dir), scratch_path(spark, "landing"),
               scratch_path(spark, "load"), dt.date(1997, 1, 1), AS_OF, PRIORITY_NAMES)
    return read_table(spark, layers, schemas.WEEKLY_METRICS).select(
        "week", "index_name", r6("avg_index_value"), r6("avg_daily_return"))


@registered("stream_weekly_average", """
WITH w AS (SELECT date_trunc('week', ts)::DATE AS week, event_type AS index_name, value FROM events)
SELECT week, index_name, round(avg(value), 6) AS avg_index_value FROM w
WHERE week + 7 <= (SELECT max(ts) - INTERVAL 1 DAY FROM events) GROUP BY ALL""")
def stream_weekly_average(spark, sf_dir):
    """Closed weeks of the event stream."""
    schema = read(spark, sf_dir, "events").schema
    # The pattern matches the table itself, be it one file or a directory of files.
    events = spark.readStream.schema(schema).option("maxFileAge", FILE_AGE).parquet(f"{sf_dir}/events.parque[t]")
    weekly = weekly_average_stream(event_ticks(events)).withColumn(
        "avg_index_value", r6("avg_index_value"))
    out = scratch_path(spark, "weekly")
    query = (
        weekly.writeStream.format("parquet").outputMode("append").option("path", out)
        .option("checkpointLocation", scratch_path(spark, "weekly-checkpoint"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(weekly.schema).parquet(out)


@registered("stream_weekly_corrected", """
WITH w AS (SELECT date_trunc('week', ts)::DATE AS week, event_type AS index_name, value, event_id % 3 = 0 AS held FROM events),
m AS (SELECT max(ts) AS seen, max(ts) FILTER (event_id % 3 <> 0) AS before FROM events)
SELECT week, index_name, round(avg(value), 6) AS avg_index_value,
  count(*) FILTER (held AND week + 7 <= (SELECT before - INTERVAL 1 DAY FROM m)) AS late_rows
FROM w WHERE week + 7 <= (SELECT seen - INTERVAL 1 DAY FROM m) GROUP BY ALL""")
def stream_weekly_corrected(spark, sf_dir):
    """Two thirds of the events come in the order of time, in two landings. The others come when most weeks are
    closed, and correct them; then the first ones come again, and count for nothing."""
    events, landing = read(spark, sf_dir, "events"), scratch_path(spark, "events")
    weeks = CorrectedWeeks(spark, scratch_path(spark, "weeks"))
    checkpoint, held = scratch_path(spark, "weekly"), F.col("event_id") % 3 == 0
    middle = events.agg(F.expr("timestampadd(SECOND, timestampdiff(SECOND, min(ts), max(ts)) DIV 2, min(ts)) AS middle"))
    early = F.col("ts") < F.lit(middle.first()["middle"]).cast(events.schema["ts"].dataType)
    for label, rows in (("early", ~held & early), ("later", ~held & ~early), ("held", held), ("again", ~held & early)):
        events.filter(rows).write.parquet(f"{landing}/{label}")
        stream = spark.readStream.schema(events.schema).option("maxFileAge", FILE_AGE).parquet(f"{landing}/*")
        weeks.drain(event_ticks(stream), checkpoint)
    return weeks.closed().withColumn("avg_index_value", r6("avg_index_value"))
