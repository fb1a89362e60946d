"""CSV export with verification."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from pricebeam.schemas import LANDED_CSV_COLUMNS
from pricebeam.sources.files import read_csv_text


class SinkVerificationError(RuntimeError):
    """The written files do not hold the rows that were sent."""


@dataclass(frozen=True)
class Export:
    path: str
    rows: int


def stamped_path(directory: str, as_of: dt.date, label: str = "daily_index_data") -> str:
    return f"{directory.rstrip('/')}/{label}_{as_of:%Y%m%d}.csv"


def write_csv(df: DataFrame, path: str, columns: tuple[str, ...] = LANDED_CSV_COLUMNS) -> int:
    """Write the columns in fixed order as a directory of part files, each with a header line, and
    return the number of rows sent. The count is observed during the write, not by a second run."""
    sent = Observation()
    (
        df.select(*columns)
        .observe(sent, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite").option("header", True)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    return sent.get["rows"]


def content_sum(schema: T.StructType) -> Column:
    """An aggregate over rows that depends on their values and copies, not on their order or files. CSV has no
    empty texts beside nulls, so the two are alike here."""
    values = [F.coalesce(F.col(f.name), F.lit("")) if isinstance(f.dataType, T.StringType) else F.col(f.name)
              for f in schema.fields]
    # A hash passes over nulls, so where they stand is hashed as well.
    digest = F.xxhash64(*values, *[F.col(f.name).isNull() for f in schema.fields if not isinstance(f.dataType, T.StringType)])
    return F.coalesce(F.sum(digest.cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)"))


def export_csv(df: DataFrame, directory: str, as_of: dt.date,
               columns: tuple[str, ...] = LANDED_CSV_COLUMNS) -> Export:
    """Write under a date-stamped name, read the files back, and compare row counts and content: a value that
    the files do not hold as it was sent fails the export. What was sent is summed up during the write, what
    is found in one pass over the files."""
    path = stamped_path(directory, as_of)
    schema = df.select(*columns).schema
    sent = Observation()
    rows = write_csv(df.select(*columns).observe(sent, content_sum(schema).alias("content")), path, columns)
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    found = read_csv_text(df.sparkSession, path, schema).select(*typed).agg(
        F.count(F.lit(1)).alias("rows"), content_sum(schema).alias("content")).first()
    if found["rows"] != rows:
        raise SinkVerificationError(f"{path}: sent {rows} rows, found {found['rows']}")
    if found["content"] != sent.get["content"]:
        raise SinkVerificationError(f"{path}: the files hold other values than were sent")
    return Export(path, rows)
