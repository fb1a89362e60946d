"""The pinned table contracts. FLOAT is 64-bit everywhere, so prices are DoubleType."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


DOUBLE, DATE, STRING = T.DoubleType(), T.DateType(), T.StringType()

# Order of the fields in a landed CSV line; binding is by position, header names are ignored.
LANDED_CSV_COLUMNS = ("value", "date", "index", "daily_return", "monthly_return")
RAW_VALUE_COLUMNS = ("index_value", "date", "index_name", "daily_return", "monthly_return")

LANDED_JSON = _struct(("date", DATE), ("index_name", STRING), ("index_value", DOUBLE))

RAW_VALUES = _struct(
    ("index_value", DOUBLE), ("date", DATE), ("index_name", STRING),
    ("daily_return", DOUBLE), ("monthly_return", DOUBLE),
)

# Where a staged row came from: when its file was written, and the file's name. Null for rows that came
# from no file.
FILE_COLUMNS = ("file_time", "file_name")
# How long that file was. With time and name it tells a file from one that replaced it.
FILE_LENGTH = "file_length"
# Of two staged rows for one key the later in these columns wins: the newer load, then the newer file.
NEWEST_BY = ("load_timestamp", "load_id", "file_time", "file_name")

# Display name by series id.
SERIES_NAMES = {
    "NASDAQCOM": "NASDAQ",
    "SP500": "S&P500",
    "DJIA": "DOW",
}


@dataclass(frozen=True)
class TableSpec:
    """One managed parquet table: its columns, key, the date column that places a row in a month
    partition, and the technical partition column that is not part of the contract."""

    layer: str
    name: str
    columns: T.StructType
    key: tuple[str, ...]
    dated_by: str | None
    partition: str = "part_month"

    @property
    def versioned(self) -> bool:
        """Tables of loads only grow; the others are rebuilt from them."""
        return self.dated_by is not None

    @property
    def column_names(self) -> list[str]:
        return self.columns.fieldNames()


RAW_STAGING = TableSpec(
    "raw", "index_staging",
    T.StructType(RAW_VALUES.fields + [
        T.StructField("load_timestamp", T.TimestampType()),
        T.StructField("file_time", T.TimestampType()), T.StructField("file_name", T.StringType())]),
    ("date", "index_name"), None, "load_id",
)
RAW_QUARANTINE = TableSpec(
    "raw", "index_quarantine",
    _struct(*[(c, STRING) for c in RAW_VALUE_COLUMNS], ("line", STRING), ("reason", STRING),
            ("load_timestamp", T.TimestampType())),
    (), None, "load_id",
)
RAW_LOADS = TableSpec(
    "raw", "index_loads",
    _struct(("file_time", T.TimestampType()), ("file_name", STRING), (FILE_LENGTH, T.LongType()),
            ("good_rows", T.LongType()), ("bad_rows", T.LongType()), ("load_timestamp", T.TimestampType())),
    (), None, "load_id",
)
HARMONIZED = TableSpec(
    "harmonized", "index_harmonized",
    _struct(("timestamp", T.TimestampNTZType()), ("index_name", STRING), ("value", DOUBLE),
            ("daily_return", DOUBLE), ("monthly_return", DOUBLE)),
    ("timestamp", "index_name"), "timestamp",
)
HARMONIZED_VOLATILITY = TableSpec(
    "harmonized", "index_harmonized_with_volatility",
    T.StructType(HARMONIZED.columns.fields
                 + [T.StructField("normalized_value", DOUBLE), T.StructField("volatility", DOUBLE)]),
    ("timestamp", "index_name"), "timestamp",
)
DAILY_METRICS = TableSpec(
    "analytics", "daily_index_metrics",
    _struct(("date", DATE), ("index_name", STRING), ("index_value", DOUBLE),
            ("daily_return", DOUBLE)),
    ("date", "index_name"), "date",
)
WEEKLY_METRICS = TableSpec(
    "analytics", "weekly_index_metrics",
    _struct(("week", DATE), ("index_name", STRING), ("avg_index_value", DOUBLE),
            ("avg_daily_return", DOUBLE)),
    ("week", "index_name"), "week",
)
MONTHLY_METRICS = TableSpec(
    "analytics", "monthly_index_metrics",
    _struct(("month", DATE), ("index_name", STRING), ("monthly_return", DOUBLE)),
    ("month", "index_name"), "month",
)
DAILY_PERFORMANCE = TableSpec(
    "analytics", "daily_performance",
    _struct(("date", DATE), ("index_name", STRING), ("value", DOUBLE), ("daily_return", DOUBLE),
            ("volatility", DOUBLE)),
    ("date", "index_name"), "date",
)
WEEKLY_PERFORMANCE = TableSpec(
    "analytics", "weekly_performance",
    _struct(("week_start", DATE), ("index_name", STRING), ("avg_value", DOUBLE),
            ("weekly_return", DOUBLE), ("volatility", DOUBLE)),
    ("week_start", "index_name"), "week_start",
)

TABLES = (
    RAW_STAGING, RAW_QUARANTINE, RAW_LOADS, HARMONIZED, HARMONIZED_VOLATILITY, DAILY_METRICS,
    WEEKLY_METRICS, MONTHLY_METRICS, DAILY_PERFORMANCE, WEEKLY_PERFORMANCE,
)
