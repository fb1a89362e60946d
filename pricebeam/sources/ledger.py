"""Which version of which landed file has been loaded, and what came of it.

A stream knows a landed file by its path alone, so a file that is corrected in place never reaches it. The
ledger table knows files by path, length and modification time: what the listing holds and the ledger does
not is loaded as a newer file.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from pricebeam import schemas
from pricebeam.schemas import FILE_COLUMNS, FILE_LENGTH
from pricebeam.sources.tables import Layers, append_load, read_table

VERSION = [*FILE_COLUMNS, FILE_LENGTH]
#: Files of a load, unless the caller says otherwise. Their list is what the driver holds.
FILES_PER_LOAD = 10_000


def listing(spark: SparkSession, landing_dir: str) -> DataFrame:
    """(path, file_time, file_name, file_length) of all landed files; no content is read."""
    time, name = (F.col(f"_metadata.{x}") for x in ("file_modification_time", "file_path"))
    try:
        files = spark.read.format("binaryFile").load(landing_dir)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, file_time timestamp, file_name string, file_length long")
    return files.select("path", time.alias(FILE_COLUMNS[0]), name.alias(FILE_COLUMNS[1]),
                        F.col("_metadata.file_size").alias(FILE_LENGTH))


def unloaded(spark: SparkSession, layers: Layers, landing_dir: str) -> DataFrame:
    """Listed files that are in no load in their present version: those replaced in place, and those that had
    no row when they were first met."""
    known = read_table(spark, layers, schemas.RAW_LOADS).select(*VERSION)
    return listing(spark, landing_dir).join(known, VERSION, "left_anti").select("path", *VERSION)


def load_token(files: list) -> str:
    """Names a load by the versions it holds, so that a repeated one replaces itself."""
    versions = sorted(f"{x.file_name}\n{x.file_length}\n{x.file_time.isoformat()}" for x in files)
    return "replaced-" + hashlib.sha256("\n".join(versions).encode()).hexdigest()[:32]


def outcomes(classified: DataFrame) -> DataFrame:
    """(file_time, file_name, file_length, good_rows, bad_rows) of the files that have rows."""
    return classified.groupBy(*VERSION).agg(F.count(F.when(F.col("reason").isNull(), 1)).alias("good_rows"),
                                            F.count("reason").alias("bad_rows"))


def enter(classified: DataFrame, layers: Layers, load_id: str, stamp, files: DataFrame | None = None) -> None:
    """Write the ledger rows of a load. `files` lists what was read, so that files without rows are entered too."""
    found = outcomes(classified)
    if files is not None:
        found = files.select(*VERSION).join(found, VERSION, "left").fillna(0, ["good_rows", "bad_rows"])
    append_load(found.select("*", stamp), layers, schemas.RAW_LOADS, load_id)
