"""Batch jobs. Each returns a status and row counts instead of printing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pricebeam import schemas
from pricebeam.functions.returns import with_returns
from pricebeam.functions.sql_functions import register_functions
from pricebeam.operators.dedupe import dedupe_latest
from pricebeam.operators.rollups import (
    daily_performance,
    monthly_max_return,
    weekly_averages,
    weekly_performance,
)
from pricebeam.operators.series import tag_series
from pricebeam.plans.harmonize import daily_metrics, harmonize, performance_input, with_volatility
from pricebeam.schemas import FILE_COLUMNS
from pricebeam.session import discard, written
from pricebeam.sources.export import export_csv
from pricebeam.sources.files import pull_series, read_csv_strict
from pricebeam.sources.tables import (
    Layers,
    append_load,
    create_layers,
    overwrite_table,
    overwrite_tables,
    read_table,
)


@dataclass(frozen=True)
class JobResult:
    status: str
    rows: Mapping[str, int] = field(default_factory=dict)


def ingest(spark: SparkSession, series_path: str, landing_dir: str, start: dt.date,
           as_of: dt.date, names: Mapping[str, str] | DataFrame = schemas.SERIES_NAMES) -> JobResult:
    """Pull all series up to `as_of`, compute returns and land one date-stamped, verified CSV."""
    pulled = tag_series(pull_series(spark, series_path, F.lit(start), F.lit(as_of), with_origin=True),
                        names, index_name="index")
    # One row per day and series, of the newest file, bounds the window groups below.
    series = dedupe_latest(pulled, ["date", "index"], FILE_COLUMNS).drop(*FILE_COLUMNS)
    returns = with_returns(series, Window.partitionBy("index").orderBy("date"), "value")
    landed = returns.withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    export = export_csv(landed, landing_dir, as_of)
    return JobResult(f"landed {export.path}", {"landed": export.rows})


def load_frame(df: DataFrame, layers: Layers, load_id: str) -> JobResult:
    """Append a frame with the staging columns as one load. Rows without a key go to quarantine,
    since no series can hold them. The frame is computed once and feeds both."""
    stamped = df.withColumn("load_timestamp", F.lit(dt.datetime.now(dt.timezone.utc)))
    stamped, path = written(stamped, "load")
    keyed = F.col("date").isNotNull() & F.col("index_name").isNotNull()
    append_load(stamped.filter(keyed), layers, schemas.RAW_STAGING, load_id)
    rejected = stamped.filter(~keyed).select(
        *[F.col(c).cast("string").alias(c) for c in schemas.RAW_VALUE_COLUMNS],
        F.lit(None).cast("string").alias("line"), F.lit("missing key").alias("reason"),
        "load_timestamp")
    append_load(rejected, layers, schemas.RAW_QUARANTINE, load_id)
    discard(df.sparkSession, path)
    return JobResult("loaded")


def load_strict(spark: SparkSession, layers: Layers, landing_dir: str, load_id: str) -> JobResult:
    """Load all files in a directory; a bad row fails the load and nothing of it is kept."""
    return load_frame(read_csv_strict(spark, landing_dir, with_origin=True), layers, load_id)


def staged_rows(spark: SparkSession, layers: Layers) -> DataFrame:
    """Raw rows with their load number, for choosing the newest."""
    spec = schemas.RAW_STAGING
    return spark.table(layers.name(spec)).select(*spec.column_names, spec.partition)


def run_harmonization(spark: SparkSession, layers: Layers) -> JobResult:
    """Rebuild both harmonized tables from raw."""
    raw = staged_rows(spark, layers)
    overwrite_table(harmonize(raw, schemas.NEWEST_BY), layers, schemas.HARMONIZED)
    harmonized = read_table(spark, layers, schemas.HARMONIZED)
    overwrite_table(with_volatility(harmonized), layers, schemas.HARMONIZED_VOLATILITY)
    return JobResult("harmonized")


def run_analytics(spark: SparkSession, layers: Layers) -> JobResult:
    """Rebuild all analytics tables from harmonized rows."""
    harmonized = read_table(spark, layers, schemas.HARMONIZED)
    priced = performance_input(harmonized)
    overwrite_tables({
        schemas.DAILY_METRICS: daily_metrics(harmonized),
        schemas.MONTHLY_METRICS: monthly_max_return(harmonized, "timestamp"),
        schemas.WEEKLY_METRICS: weekly_averages(harmonized, "timestamp", "value"),
        schemas.DAILY_PERFORMANCE: daily_performance(priced),
        schemas.WEEKLY_PERFORMANCE: weekly_performance(priced),
    }, layers)
    return JobResult("analytics rebuilt")


def table_rows(spark: SparkSession, layers: Layers, *specs: schemas.TableSpec) -> dict[str, int]:
    return {spec.name: read_table(spark, layers, spec).count() for spec in specs}


def end_to_end(spark: SparkSession, layers: Layers, series_path: str, landing_dir: str,
               checkpoint: str, start: dt.date, as_of: dt.date,
               names: Mapping[str, str] | DataFrame = schemas.SERIES_NAMES) -> JobResult:
    """Everything in order: tables, functions, pull, load each landed file once, harmonize, analytics."""
    from pricebeam.streaming.refresh import load_raw_data

    create_layers(spark, layers)
    register_functions(spark)
    ingest(spark, series_path, landing_dir, start, as_of, names)
    load_raw_data(spark, layers, f"{landing_dir}/*", checkpoint)
    run_harmonization(spark, layers)
    run_analytics(spark, layers)
    return JobResult("complete", table_rows(spark, layers, *schemas.TABLES))
