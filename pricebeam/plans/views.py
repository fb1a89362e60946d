"""The dashboard's queries. Charts and preview read stored tables or any frame of the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricebeam import schemas
from pricebeam.operators.rollups import monthly_average
from pricebeam.sources.tables import Layers, read_table

PREVIEW_ROWS = 1000

# What a viewer may choose, by layer.
PREVIEWABLE = {
    "raw": (schemas.RAW_STAGING,),
    "harmonized": (schemas.HARMONIZED,),
    "analytics": (schemas.DAILY_METRICS, schemas.WEEKLY_METRICS, schemas.MONTHLY_METRICS),
}


def preview(df: DataFrame, keys: list[str], rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows by key. Sort and limit run as one top-k: each task keeps `rows` rows."""
    rest = [c for c in df.columns if c not in keys]
    return df.orderBy(*keys, *rest).limit(rows)


def preview_table(spark: SparkSession, layers: Layers, layer: str, table: str,
                  rows: int = PREVIEW_ROWS) -> DataFrame:
    """Preview of a table chosen by name. Only names on the list reach the catalog."""
    for spec in PREVIEWABLE.get(layer, ()):
        if spec.name == table:
            return preview(read_table(spark, layers, spec), list(spec.key), rows)
    raise ValueError(f"{layer}.{table} is not a previewable table")


def chart_daily_value(daily_metrics: DataFrame) -> DataFrame:
    return daily_metrics.select("date", "index_name", "index_value").orderBy("date", "index_name")


def chart_daily_return(daily_metrics: DataFrame) -> DataFrame:
    return daily_metrics.select("date", "index_name", "daily_return").orderBy("date", "index_name")


def chart_weekly_value(weekly_metrics: DataFrame) -> DataFrame:
    return weekly_metrics.select("week", "index_name", "avg_index_value").orderBy(
        "week", "index_name")


def chart_weekly_return(weekly_metrics: DataFrame) -> DataFrame:
    return weekly_metrics.select("week", "index_name", "avg_daily_return").orderBy(
        "week", "index_name")


def chart_monthly_value(daily_metrics: DataFrame) -> DataFrame:
    """Monthly average of the daily values; the monthly table itself holds no value column."""
    return monthly_average(daily_metrics).orderBy("month", "index_name")


def chart_monthly_return(monthly_metrics: DataFrame) -> DataFrame:
    return monthly_metrics.select("month", "index_name", "monthly_return").orderBy(
        "month", "index_name")
