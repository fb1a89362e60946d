"""Named functions for SQL callers. Their bodies are SQL, so calls stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import SparkSession

from pricebeam.functions.volatility import ARRAY_VOLATILITY_SQL

NORMALIZE_NAMES = ("normalize_exchange_rate", "normalize_index_value")
VOLATILITY_NAME = "calculate_volatility"


def register_functions(spark: SparkSession) -> list[str]:
    """Register (or replace) the normalize function under both its names, and the volatility one."""
    for name in NORMALIZE_NAMES:
        spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(v DOUBLE) RETURNS DOUBLE
                      RETURN coalesce(try_divide(v, abs(v)), 0.0D)""")
    body = ARRAY_VOLATILITY_SQL.format(a="prices")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {VOLATILITY_NAME}(prices ARRAY<DOUBLE>)
                  RETURNS DOUBLE RETURN {body}""")
    return [*NORMALIZE_NAMES, VOLATILITY_NAME]
