"""Load-once ingestion and the incremental refresh of the metric tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from pricebeam import schemas
from pricebeam.functions.dates import as_of_date, week_start
from pricebeam.functions.volatility import with_frame_volatility
from pricebeam.operators.rollups import (
    FRAME_ROWS,
    LONG_FRAME_ROWS,
    LOOKBACK_DAYS,
    current_month_max_return,
    monthly_max_return,
    recent_daily_performance,
    recent_weekly_performance,
    weekly_averages,
    weekly_performance,
)
from pricebeam.plans.harmonize import daily_metrics, harmonize, performance_input, with_volatility
from pricebeam.plans.jobs import JobResult
from pricebeam.session import discard, materialize, shared_dir, written
from pricebeam.sources.files import FILE_AGE, bad_rows, classify, good_rows, read_csv_text, read_json_text, stream_text
from pricebeam.sources.ledger import FILES_PER_LOAD, VERSION, enter, load_token, unloaded
from pricebeam.sources.tables import (
    OVERWRITE_MODE,
    Layers,
    append_load,
    in_months,
    read_table,
    refresh_listings,
    upsert_table,
    upsert_tables,
)
from pricebeam.streaming.pending import PendingKeys

NO_NEW_DATA = "no new data"

# How many months before the first changed one are read; more only for series sparser than that.
READ_BACK_MONTHS = 3


def drain(stream: DataFrame, checkpoint: str,
          process: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """One scheduled run: process everything new since the checkpoint, then stop."""
    query = (
        stream.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def load_raw_data(spark: SparkSession, layers: Layers, landing_dir: str, checkpoint: str,
                  files_per_batch: int | None = None, kind: str = "csv") -> JobResult:
    """Load each landed file once, whatever its date: good rows to staging, bad rows to quarantine, one
    load id per batch. A batch that is repeated after a failure replaces its own load.
    `files_per_batch` cuts a large first load into several; `kind` is csv or json.

    Every load enters its files in the ledger, by path, length and time, with their good and bad rows. Files
    that were replaced in place since are loaded after the new ones, as newer files: their rows win by key, and
    rows that the newer file no longer has stay."""
    loaded = {"loads": 0, "replaced": 0}

    def process(batch: DataFrame, batch_id: int) -> None:
        _load(batch, layers, batch_token(spark, checkpoint, batch_id), kind)
        loaded["loads"] += 1

    drain(stream_text(spark, landing_dir, files_per_batch=files_per_batch, kind=kind), checkpoint, process)
    refresh_listings(spark, layers)
    while True:
        spark.catalog.refreshTable(layers.name(schemas.RAW_LOADS))
        files = unloaded(spark, layers, landing_dir).orderBy(*VERSION).limit(files_per_batch or FILES_PER_LOAD).collect()
        if not files:
            break
        read = read_json_text(spark, [x.path for x in files]) if kind == "json" else read_csv_text(
            spark, [x.path for x in files])
        listed = spark.createDataFrame(files, "path string, file_time timestamp, file_name string, file_length long")
        if _load(read, layers, load_token(files), kind, listed):
            loaded["loads"] += 1
            loaded["replaced"] += len(files)
    refresh_listings(spark, layers)
    return JobResult("loaded" if loaded["loads"] else NO_NEW_DATA, loaded)


def _load(text: DataFrame, layers: Layers, load_id: str, kind: str, files: DataFrame | None = None) -> bool:
    """Classify rows and append them as one load; whether there were any."""
    spark = text.sparkSession
    schema = schemas.LANDED_JSON if kind == "json" else schemas.RAW_VALUES
    stamp = F.lit(dt.datetime.now(dt.timezone.utc)).alias("load_timestamp")
    # Each file is parsed once; all sinks read the classified rows.
    rows, path = written(classify(text, schema), "classified")
    good = _with_columns(good_rows(rows, schema, with_origin=True), schemas.RAW_VALUES)
    bad = _with_columns(bad_rows(rows), schemas.RAW_QUARANTINE.columns, but="load_timestamp")
    append_load(good.select("*", stamp), layers, schemas.RAW_STAGING, load_id)
    append_load(bad.select("*", stamp), layers, schemas.RAW_QUARANTINE, load_id)
    # The ledger comes last: a load that died before is repeated whole.
    enter(rows, layers, load_id, stamp, files)
    found = not rows.isEmpty()
    discard(spark, path)
    return found


def _with_columns(df: DataFrame, schema: T.StructType, but: str = "") -> DataFrame:
    """The frame with those of the schema's columns that it lacks, as nulls."""
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema.fields
                           if f.name not in df.columns and f.name != but})


def batch_token(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """Names one batch of one checkpoint. The query id comes from the checkpoint itself, so a new
    checkpoint at an old place never meets the traces of its predecessor."""
    query_id = spark.read.json(f"{checkpoint}/metadata").first()["id"]
    return f"{query_id}-{batch_id:09d}"


def staging_stream(spark: SparkSession, layers: Layers) -> DataFrame:
    """Rows appended to the staging table since the reader's checkpoint."""
    spec = schemas.RAW_STAGING
    reader = spark.readStream.option("maxFileAge", FILE_AGE)
    return reader.table(layers.name(spec)).select(*spec.column_names, spec.partition)


def update_daily_index_metrics(spark: SparkSession, layers: Layers, checkpoint: str,
                               as_of: dt.date | str | None = None,
                               strict_reference: bool = False) -> JobResult:
    """Bring harmonized and analytics tables up to date with the new staging rows.

    Default mode recomputes exactly what the new rows affect, however old they are. With
    `strict_reference` the three performance upserts use fixed lookbacks before `as_of`: the
    current month, 30 days and four weeks. In both, derived tables hold no day after `as_of`: later
    rows stay in the harmonized table and are derived by the first refresh whose `as_of` reaches them,
    whether or not that refresh meets new rows. What was derived before an `as_of` that goes back stays.
    """
    done = {"batches": 0, "derived": 0}
    day = spark.range(1).select(as_of_date(as_of)).first()[0]

    def process(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        done["derived"] += apply_batch(batch, layers, batch_token(spark, checkpoint, batch_id), day, strict_reference)
        done["batches"] += 1

    drain(staging_stream(spark, layers), checkpoint, process)
    # The stream wrote in a session of its own; this one still lists the files before.
    refresh_listings(spark, layers)
    done["derived"] += derive_pending(spark, layers, day, strict_reference)
    refresh_listings(spark, layers)
    return JobResult("updated" if done["batches"] or done["derived"] else NO_NEW_DATA, done)


def apply_batch(batch: DataFrame, layers: Layers, token: str, as_of: dt.date,
                strict_reference: bool = False) -> int:
    """Fan one batch out to harmonized rows, note their keys, and derive what `as_of` has reached; the number
    of keys derived.

    The deduplicated batch is written once to the shared folder; all later steps read that copy. Every
    write replaces by key, so a repeated batch changes nothing.
    """
    spark = batch.sparkSession
    # The streaming query has this session to itself.
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    staged = f"{shared_dir(spark)}/pricebeam/batches/{token}"
    harmonize(batch, schemas.NEWEST_BY).write.mode("overwrite").parquet(staged)
    arrived = spark.read.schema(schemas.HARMONIZED.columns).parquet(staged)
    upsert_table(arrived, layers, schemas.HARMONIZED, token, unique=True)
    day = F.col("timestamp").cast("date").alias("date")
    PendingKeys(spark, layers).note(arrived.select(day, "index_name"), token)
    derived = derive_pending(spark, layers, as_of, strict_reference)
    discard(spark, staged)
    return derived


def derive_pending(spark: SparkSession, layers: Layers, as_of: dt.date, strict_reference: bool = False) -> int:
    """Bring the derived tables up to date with all rows up to `as_of` that wait; the number of their keys."""
    def work(keys: DataFrame, until: dt.date, token: str) -> None:
        _derive(keys, layers, F.lit(until), token, strict_reference)

    previous = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        return PendingKeys(spark, layers).derive(as_of, work)
    finally:
        spark.conf.set(OVERWRITE_MODE, previous)


def _derive(keys: DataFrame, layers: Layers, as_of: Column, token: str, strict_reference: bool) -> None:
    spark = keys.sparkSession
    months = [x[0] for x in keys.select(F.trunc("date", "month")).distinct().collect()]
    stored = in_months(spark.table(layers.name(schemas.HARMONIZED)), months)
    changed, path = written(
        stored.withColumn("date", F.col("timestamp").cast("date")).join(keys, ["date", "index_name"], "left_semi")
        .select(*schemas.HARMONIZED.column_names), "changed")
    refreshed = {schemas.DAILY_METRICS: daily_metrics(changed)}
    if strict_reference:
        refreshed |= _fixed_lookback_refresh(spark, layers, as_of)
    else:
        refreshed |= _affected_refresh(spark, layers, changed, as_of)
    upsert_tables(refreshed, layers, token)
    discard(spark, path)


def _fixed_lookback_refresh(spark: SparkSession, layers: Layers,
                            as_of: Column) -> dict[schemas.TableSpec, DataFrame]:
    raw = read_table(spark, layers, schemas.RAW_STAGING)
    # The earliest lookback is 30 days, so only the months since then are read.
    earliest = F.trunc(F.date_sub(as_of, LOOKBACK_DAYS), "month")
    stored = spark.table(layers.name(schemas.HARMONIZED)).filter(F.col("part_month") >= earliest)
    priced = performance_input(stored)
    return {
        schemas.MONTHLY_METRICS: current_month_max_return(raw, as_of),
        schemas.DAILY_PERFORMANCE: recent_daily_performance(priced, as_of, strict_reference=True),
        schemas.WEEKLY_PERFORMANCE: recent_weekly_performance(priced, as_of, strict_reference=True),
    }


def _affected_refresh(spark: SparkSession, layers: Layers, changed: DataFrame,
                      as_of: Column) -> dict[schemas.TableSpec, DataFrame]:
    stored = spark.table(layers.name(schemas.HARMONIZED)).filter(
        (F.col("timestamp").cast("date") <= as_of) & (F.col("part_month") <= as_of))
    days = changed.select(F.col("timestamp").cast("date").alias("date"), "index_name")
    # Calendar lists, not row lists: a batch touches few months however many rows it has.
    months = sorted(r[0] for r in days.select(F.trunc("date", "month")).distinct().collect())
    weeks = days.select(week_start("date").alias("week"), "index_name").distinct()
    by_month = in_months(stored, months)
    touched_months = days.select(F.trunc("date", "month").alias("part_month"),
                                 "index_name").distinct()
    in_weeks = in_months(stored, _with_neighbours(months)).withColumn(
        "week", week_start(F.col("timestamp").cast("date"))
    ).join(weeks, ["week", "index_name"], "left_semi").drop("week")
    return {
        schemas.MONTHLY_METRICS: monthly_max_return(
            by_month.join(touched_months, ["part_month", "index_name"], "left_semi"), "timestamp"),
        schemas.WEEKLY_METRICS: weekly_averages(in_weeks, "timestamp", "value"),
        schemas.WEEKLY_PERFORMANCE: weekly_performance(performance_input(in_weeks)),
        schemas.DAILY_PERFORMANCE: affected_daily_performance(stored, days, min(months)),
        schemas.HARMONIZED_VOLATILITY: affected_volatility(stored, days, min(months)),
    }


def _with_neighbours(months: list[dt.date]) -> list[dt.date]:
    """The months and those next to them, since a week can lie across a month's edge."""
    wide = set(months)
    for month in months:
        wide.add((month - dt.timedelta(days=1)).replace(day=1))
        wide.add((month + dt.timedelta(days=31)).replace(day=1))
    return sorted(wide)


def affected_daily_performance(stored: DataFrame, changed: DataFrame, first_month: dt.date,
                               rows: int = FRAME_ROWS) -> DataFrame:
    """Daily performance of every row whose trailing frame holds a changed row.

    `stored` is the harmonized table with its month partition, `changed` the changed (date, index)
    keys, the first of them in `first_month`.
    """
    history = affected_frames(stored, changed, first_month, rows)
    window = Window.partitionBy("index_name").orderBy("timestamp")
    computed = with_frame_volatility(history, window, "value", rows).filter("affected")
    return computed.select(F.col("timestamp").cast("date").alias("date"), "index_name", "value",
                           "daily_return", "volatility")


def affected_volatility(stored: DataFrame, changed: DataFrame, first_month: dt.date,
                        rows: int = LONG_FRAME_ROWS) -> DataFrame:
    """Rows of the harmonized table with volatility whose thirty-row frame holds a changed row."""
    history = affected_frames(stored, changed, first_month, rows)
    return with_volatility(history).filter("affected").select(
        *schemas.HARMONIZED_VOLATILITY.column_names)


def affected_frames(stored: DataFrame, changed: DataFrame, first_month: dt.date,
                    rows: int) -> DataFrame:
    """The rows whose trailing `rows`-row frame holds a changed row (`affected`), and before them the
    rows that their frames need.

    Only changed series are read, each from a few months before its own first change to a few months
    after its own last; series that are too sparse for a full frame there are read wholly on that
    side.
    """
    bounds = changed.groupBy("index_name").agg(F.min("date").alias("_first"), F.max("date").alias("_last"))
    of_changed = stored.join(bounds, "index_name")
    day = F.col("timestamp").cast("date")
    month = F.col("part_month")
    low = F.add_months(F.trunc("_first", "month"), -READ_BACK_MONTHS)
    high = F.add_months(F.trunc("_last", "month"), READ_BACK_MONTHS)
    pruned = of_changed.filter(month >= F.add_months(F.lit(first_month), -READ_BACK_MONTHS))
    near = pruned.filter(month.between(low, high))
    counted = near.groupBy("index_name").agg(
        F.count(F.when(day < F.col("_first"), 1)).alias("before"),
        F.count(F.when(day > F.col("_last"), 1)).alias("after"))
    counted = materialize(counted.filter((F.col("before") < rows - 1) | (F.col("after") < rows - 1)), "sparse")
    if not counted.isEmpty():
        older = of_changed.filter(month < low).join(
            counted.filter(F.col("before") < rows - 1).select("index_name"), "index_name", "left_semi")
        newer = pruned.filter(month > high).join(
            counted.filter(F.col("after") < rows - 1).select("index_name"), "index_name", "left_semi")
        near = near.unionByName(older).unionByName(newer)
    keyed = changed.select(F.col("date").alias("_day"), F.col("index_name").alias("_index"),
                           F.lit(True).alias("_changed")).distinct()
    marked = near.join(keyed, (day == F.col("_day")) & (F.col("index_name") == F.col("_index")), "left")
    frame = Window.partitionBy("index_name").orderBy("timestamp").rowsBetween(-(rows - 1), 0)
    return marked.withColumn("affected", F.coalesce(F.max("_changed").over(frame), F.lit(False))).select(
        *schemas.HARMONIZED.column_names, "affected")
