"""Given tables seen as price series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricebeam.functions.returns import with_returns
from pricebeam.operators.dedupe import dedupe_latest
from pricebeam.operators.rollups import daily_series_window

AS_OF = dt.date(2001, 7, 31)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def order_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as one price of its priority's series; several per day."""
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_orderpriority").alias("index_name"),
        F.col("o_totalprice").alias("index_value"),
        F.col("o_orderkey").alias("seq"),
    )


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price per (date, index): the highest order key wins."""
    return dedupe_latest(order_ticks(spark, sf_dir), ["date", "index_name"], ["seq"],
                         unique_order=True)


def daily_series_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every 11th key's value missing."""
    return daily_series(spark, sf_dir).withColumn(
        "index_value", F.when(F.col("seq") % 11 != 0, F.col("index_value")))


def raw_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging columns: daily prices with their one-row and thirty-row returns."""
    return with_returns(daily_series(spark, sf_dir), daily_series_window()).drop("seq")


def part_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series per part, every line item as one price; the number of rows per series is open."""
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_partkey").alias("index_name"),
        F.col("l_extendedprice").alias("value"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
    )


PART_TICK_ORDER = ["date", "order_key", "line_number", "value"]


def event_ticks(events: DataFrame) -> DataFrame:
    """Events as prices. Watermarks need an instant, so wall-clock time is read as if it were UTC."""
    return events.select(
        F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone()).alias("ts"),
        F.col("event_type").alias("index_name"),
        F.col("value").alias("index_value"),
        F.col("event_id"),
    )
