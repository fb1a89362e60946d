"""Landed CSV and JSON files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pricebeam.schemas import FILE_COLUMNS, FILE_LENGTH, LANDED_JSON, RAW_VALUES

# Tokens of a missing value in landed files, and in pulled series files.
NULL_TOKENS = ("", "NULL")
PULL_NULL_TOKENS = ("", "NULL", ".")
BROKEN_LINE = "_broken_line"
# How a date and a number are written. A cast alone would take "2024-01" and "10.5d".
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
NUMBER_PATTERN = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$|^NaN$"
# A file stream forgets files older than this, counted from the newest it has seen, and never loads
# them. Copied and restored files can have any date, so this is beyond any of them.
FILE_AGE = "36500d"


def _text_schema(schema: T.StructType) -> T.StructType:
    names = [*schema.fieldNames(), BROKEN_LINE]
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def _text_reader(reader, schema: T.StructType, delimiter: str):
    """Every field as text, bound by position, one header line per file skipped. Lines with too few
    or too many fields are kept whole in `_broken_line`."""
    return (
        reader.schema(_text_schema(schema))
        .option("header", True)
        .option("sep", delimiter)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BROKEN_LINE)
    )


def with_file(rows: DataFrame) -> DataFrame:
    """Adds the time, name and length of each row's file, so that a newer file can win over an older one."""
    return rows.select("*", F.col("_metadata.file_modification_time").alias(FILE_COLUMNS[0]),
                       F.col("_metadata.file_path").alias(FILE_COLUMNS[1]),
                       F.col("_metadata.file_size").alias(FILE_LENGTH))


def read_csv_text(spark: SparkSession, path: str | list[str], schema: T.StructType = RAW_VALUES,
                  delimiter: str = ",") -> DataFrame:
    return with_file(_text_reader(spark.read, schema, delimiter).csv(path))


def read_json_text(spark: SparkSession, path: str | list[str], schema: T.StructType = LANDED_JSON) -> DataFrame:
    """Every field as text; a line that is no JSON object is kept whole in `_broken_line`."""
    return with_file(_json_reader(spark.read, schema).json(path))


def _json_reader(reader, schema: T.StructType):
    return (reader.schema(_text_schema(schema)).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", BROKEN_LINE))


def stream_text(spark: SparkSession, path: str, schema: T.StructType | None = None,
                delimiter: str = ",", files_per_batch: int | None = None,
                kind: str = "csv") -> DataFrame:
    """CSV or JSON lines as a stream: each file in the directory is delivered once per checkpoint,
    whatever its date, oldest first, in batches of at most `files_per_batch` files when that is
    given."""
    if kind == "json":
        reader = _json_reader(spark.readStream, schema or LANDED_JSON)
    else:
        reader = _text_reader(spark.readStream, schema or RAW_VALUES, delimiter)
    reader = reader.option("maxFileAge", FILE_AGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return with_file(reader.format(kind).load(path))


def null_tokens(column: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    return F.when(~column.isin(*tokens), column)


def classify(text: DataFrame, schema: T.StructType = RAW_VALUES,
             tokens: Sequence[str] = NULL_TOKENS,
             required: Sequence[str] = ("date", "index_name")) -> DataFrame:
    """Typed columns beside their text (`_text`), the file's columns if there, and `reason`, null for
    a good row.

    A row is bad when its line was broken, a field that is not a null token is not written as its
    type is, or a key field is missing, since such a row has no place in any series.
    """
    broken = F.col(BROKEN_LINE).isNotNull()
    fields = {f.name: null_tokens(F.col(f.name), tokens) for f in schema.fields}
    typed = {f.name: parsed(fields[f.name], f.dataType) for f in schema.fields}
    failed = [
        F.when((F.lit(n in required) | fields[n].isNotNull()) & typed[n].isNull(), F.lit(n))
        for n in fields
    ]
    reason = F.when(broken, F.lit("field count")).otherwise(
        F.nullif(F.concat_ws(",", *failed), F.lit("")))
    return text.select(
        *[typed[n].alias(n) for n in fields],
        F.struct(*[F.col(n) for n in fields], F.col(BROKEN_LINE).alias("line")).alias("_text"),
        reason.alias("reason"),
        *[F.col(c) for c in (*FILE_COLUMNS, FILE_LENGTH) if c in text.columns],
    )


def parsed(text: Column, kind: T.DataType) -> Column:
    """The value of a field, null if it is not written as its type is. Infinite numbers are none."""
    text = F.trim(text)
    if isinstance(kind, T.DateType):
        return F.when(text.rlike(DATE_PATTERN), text.try_cast(kind))
    if isinstance(kind, T.DoubleType):
        number = F.when(text.rlike(NUMBER_PATTERN), text.try_cast(kind))
        return F.when(F.isnan(number) | (F.abs(number) < float("inf")), number)
    return text.try_cast(kind)


def _typed(classified: DataFrame, schema: T.StructType, *also: str) -> DataFrame:
    """The typed columns. NaN is turned into null, since a maximum over NaN is NaN."""
    return classified.select(*[
        F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in schema.fields], *also)


def good_rows(classified: DataFrame, schema: T.StructType = RAW_VALUES,
              with_origin: bool = False) -> DataFrame:
    """The good rows' typed columns; with their files' columns if asked for."""
    also = FILE_COLUMNS if with_origin else ()
    return _typed(classified.filter(F.col("reason").isNull()), schema, *also)


def bad_rows(classified: DataFrame) -> DataFrame:
    """Rows set aside, with their text as it was read and the fields that failed."""
    return classified.filter(F.col("reason").isNotNull()).select("_text.*", "reason")


def _strictly(classified: DataFrame, schema: T.StructType, with_origin: bool) -> DataFrame:
    stop = F.raise_error(F.concat(F.lit("bad row, "), F.col("reason"), F.lit(": "),
                                  F.to_json("_text")))
    # As a filter the check also runs when no column is asked for, as in a count.
    checked = classified.filter(F.col("reason").isNull() | stop.cast("boolean"))
    return _typed(checked, schema, *(FILE_COLUMNS if with_origin else ()))


def read_csv_strict(spark: SparkSession, path: str, schema: T.StructType = RAW_VALUES,
                    delimiter: str = ",", tokens: Sequence[str] = NULL_TOKENS,
                    with_origin: bool = False) -> DataFrame:
    """Typed rows; the query fails on the first bad one."""
    return _strictly(classify(read_csv_text(spark, path, schema, delimiter), schema, tokens), schema,
                     with_origin)


def read_json(spark: SparkSession, path: str, schema: T.StructType = LANDED_JSON,
              tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Typed rows of JSON lines; the query fails on the first bad one. For the tolerant way, `classify`
    what `read_json_text` gives."""
    return _strictly(classify(read_json_text(spark, path, schema), schema, tokens), schema, False)


def pull_series(spark: SparkSession, path: str, start: Column, end: Column,
                tokens: Sequence[str] = PULL_NULL_TOKENS, with_origin: bool = False) -> DataFrame:
    """Every series below `path` in one DataFrame, trimmed to the date range: one directory
    `series_id=<id>` of (date, value) CSV files per series. Missing values are null; a line with too
    few or too many fields and a field that does not parse fail the pull."""
    names = ("date", "value", BROKEN_LINE, "series_id")
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    fields = {"date": F.col("date"), "value": null_tokens(F.col("value"), tokens)}
    typed = {"date": parsed(fields["date"], T.DateType()), "value": parsed(fields["value"], T.DoubleType())}
    parses = (F.col(BROKEN_LINE).isNull() & typed["date"].isNotNull()
              & (fields["value"].isNull() | typed["value"].isNotNull()))
    stop = F.raise_error(F.concat_ws(" ", F.lit("bad series row:"), *names)).cast("boolean")
    rows = with_file(spark.read.schema(text).option("header", True).option("mode", "PERMISSIVE")
                     .option("columnNameOfCorruptRecord", BROKEN_LINE).csv(path)).filter(parses | stop)
    also = FILE_COLUMNS if with_origin else ()
    number = F.when(~F.isnan(typed["value"]), typed["value"])
    return rows.select("series_id", typed["date"].alias("date"), number.alias("value"), *also).filter(
        F.col("date").between(start, end))
