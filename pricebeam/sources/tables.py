"""The raw, harmonized and analytics tables: parquet, partitioned, written through Spark.

Tables that are rebuilt as a whole have versions: the name is a view, each rebuild writes a catalog table of
its own, and one change of the view makes it current. A reader stays with the version that it resolved, and a
rebuild that dies before the change leaves nothing but a table that no name leads to.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pricebeam import schemas
from pricebeam.functions.dates import month_start
from pricebeam.operators.changes import keyed_changes
from pricebeam.operators.upsert import DuplicateKeyError, upsert
from pricebeam.schemas import TableSpec
from pricebeam.session import discard, path_exists, shared_dir
from pricebeam.sources.change_log import REBUILD, ChangeLog

LAYERS = ("raw", "harmonized", "analytics")
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
#: Table property of a version: when a cleanup first met it out of use.
UNUSED_SINCE = "pricebeam.unused_since"


@dataclass(frozen=True)
class Layers:
    """Table names of one environment. `prefix` tells environments apart, e.g. `dev_`. Every upsert and rebuild
    of the tables in `logged` notes the rows that it changed, see `change_log`."""

    prefix: str = ""
    root: str | None = None
    logged: tuple[str, ...] = ()

    def database(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def name(self, spec: TableSpec) -> str:
        return f"{self.database(spec.layer)}.{spec.name}"


def create_layers(spark: SparkSession, layers: Layers) -> list[str]:
    """Create the databases and tables that do not exist yet."""
    for layer in LAYERS:
        place = f" LOCATION '{layers.root}/{layer}'" if layers.root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layers.database(layer)}{place}")
    for spec in schemas.TABLES:
        name = layers.name(spec)
        if not spec.versioned:
            _create(spark, name, spec, "IF NOT EXISTS ")
        elif not spark.catalog.tableExists(name):
            spark.sql(f"CREATE VIEW IF NOT EXISTS {name} AS {_selection(_new_version(spark, name, spec))}")
    return [layers.name(spec) for spec in schemas.TABLES]


def _create(spark: SparkSession, table: str, spec: TableSpec, condition: str = "") -> None:
    partition_type = "STRING" if spec.dated_by is None else "DATE"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.columns.fields)
    spark.sql(f"CREATE TABLE {condition}{table} ({columns}, {spec.partition} {partition_type}) "
              f"USING parquet PARTITIONED BY ({spec.partition})")


def _new_version(spark: SparkSession, name: str, spec: TableSpec) -> str:
    table = f"{name}__{uuid.uuid4().hex}"
    _create(spark, table, spec)
    return table


def _selection(version: str) -> str:
    return f"SELECT * FROM {version}"


def stored_table(spark: SparkSession, layers: Layers, spec: TableSpec) -> str:
    """The catalog table that holds the rows now: the current version, or the table itself if it has none."""
    name = layers.name(spec)
    if not spec.versioned:
        return name
    text = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'View Text'").first()
    return text["data_type"].removeprefix(_selection("")) if text else name


def _versions(spark: SparkSession, layers: Layers, spec: TableSpec) -> list[str]:
    database = layers.database(spec.layer)
    found = spark.sql(f"SHOW TABLES IN {database} LIKE '{spec.name}__*'").collect()
    return [f"{database}.{x.tableName}" for x in found if re.fullmatch(spec.name + "__[0-9a-f]{32}", x.tableName)]


def remove_old_versions(spark: SparkSession, layers: Layers, now: dt.datetime, age: dt.timedelta) -> list[str]:
    """Drop the versions that have been out of use for `age`, and return their names.

    A cleanup notes when it first meets a version out of use; a later one, `age` after that, drops it. So age
    counts from a time at which the version was surely replaced (or left by a rebuild that died), whatever
    failed in between. Choose an age longer than any read and any rebuild.
    """
    dropped = []
    for spec in schemas.TABLES:
        if not spec.versioned:
            continue
        current = stored_table(spark, layers, spec)
        for version in _versions(spark, layers, spec):
            properties = {x.key: x.value for x in spark.sql(f"SHOW TBLPROPERTIES {version}").collect()}
            since = properties.get(UNUSED_SINCE)
            if version == current:
                if since is not None:
                    _use(spark, version)
            elif since is None:
                spark.sql(f"ALTER TABLE {version} SET TBLPROPERTIES ('{UNUSED_SINCE}' = '{now.isoformat()}')")
            elif dt.datetime.fromisoformat(since) + age <= now:
                spark.sql(f"DROP TABLE IF EXISTS {version}")
                dropped.append(version)
    return dropped


def _use(spark: SparkSession, version: str) -> None:
    spark.sql(f"ALTER TABLE {version} UNSET TBLPROPERTIES IF EXISTS ('{UNUSED_SINCE}')")


def change_log(spark: SparkSession, layers: Layers, spec: TableSpec) -> ChangeLog:
    """What upserts and rebuilds changed in the table since it is logged."""
    place = spark.catalog.getDatabase(layers.database(spec.layer)).locationUri
    return ChangeLog(spark, f"{place}/{spec.name}__changes", spec.columns)


def _log_for(spark: SparkSession, layers: Layers, spec: TableSpec, table: str) -> ChangeLog | None:
    """The log to write to, rid of what a rebuild that died left in it."""
    if spec.name not in layers.logged or not spec.versioned:
        return None
    log = change_log(spark, layers, spec)
    log.settle(table.rsplit(".", 1)[-1])
    return log


def read_table(spark: SparkSession, layers: Layers, spec: TableSpec) -> DataFrame:
    """The contract columns, without the partition column."""
    return spark.table(layers.name(spec)).select(*spec.column_names)


def refresh_listings(spark: SparkSession, layers: Layers) -> None:
    """Forget the file listings that this session keeps of the tables. Another session, or a stream's
    own, may have replaced files since; a read by the old listing would fail."""
    for spec in schemas.TABLES:
        spark.catalog.refreshTable(stored_table(spark, layers, spec))


def in_months(df: DataFrame, months: list, partition: str = "part_month") -> DataFrame:
    """Rows of the given month partitions, pruned at the scan. None stands for undated rows."""
    tests = []
    dated = [m for m in months if m is not None]
    if dated:
        tests.append(F.col(partition).isin(dated))
    if len(dated) < len(months):
        tests.append(F.col(partition).isNull())
    return df.filter(reduce(Column.__or__, tests)) if tests else df.filter(F.lit(False))


def month_of(spec: TableSpec) -> Column:
    return month_start(F.col(spec.dated_by).cast("date"))


def _for_table(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Table column order plus the partition column. The rebalance lets AQE split a month that holds
    much of the data and join small ones, so files come out evenly sized."""
    return df.select(*spec.column_names, month_of(spec).alias(spec.partition)).hint(
        "rebalance", F.col(spec.partition))


def _replace(df: DataFrame, table: str, scope: str) -> None:
    """Insert over the whole table (`static`) or over the partitions that occur in `df` (`dynamic`).

    insertInto takes the scope from the session only. A session that already has it is left alone,
    so writers that share such a session may run side by side.
    """
    conf = df.sparkSession.conf
    previous = conf.get(OVERWRITE_MODE)
    if previous.lower() == scope:
        df.write.mode("overwrite").insertInto(table)
        return
    conf.set(OVERWRITE_MODE, scope)
    try:
        df.write.mode("overwrite").insertInto(table)
    finally:
        conf.set(OVERWRITE_MODE, previous)


def overwrite_table(df: DataFrame, layers: Layers, spec: TableSpec) -> None:
    """Replace the whole content by a new version; `df` may read the table that it replaces. Readers of the
    old version finish with its rows, until `remove_old_versions` drops it. A run that dies before the switch
    changes nothing. Writers of one table run one after the other: an upsert that ends during the rebuild
    went into the old version. A table made without versions is replaced in place; then `df` must not read it,
    and a run that dies half way is repaired by repeating it.
    """
    spark, name = df.sparkSession, layers.name(spec)
    current = stored_table(spark, layers, spec)
    log = _log_for(spark, layers, spec, current)
    if current == name:
        if log is not None:
            raise ValueError(f"{name} has no versions, so its rebuilds cannot be logged")
        _replace(_for_table(df, spec), name, "static")
        return
    version = _new_version(spark, name, spec)
    _for_table(df, spec).write.insertInto(version)
    token = REBUILD + version.rsplit(".", 1)[-1]
    if log is not None:
        before, after = (spark.table(t).select(*spec.column_names) for t in (current, version))
        log.record(keyed_changes(before, after, spec.key, whole=True), token)
    _use(spark, version)
    _switch(spark, name, version)
    if log is not None:
        log.publish(token)


def _switch(spark: SparkSession, name: str, version: str) -> None:
    """One change in the catalog."""
    spark.sql(f"ALTER VIEW {name} AS {_selection(version)}")


def overwrite_tables(frames: Mapping[TableSpec, DataFrame], layers: Layers) -> None:
    """Rebuild several tables that do not read each other; their jobs share the cluster."""
    conf = next(iter(frames.values())).sparkSession.conf
    previous = conf.get(OVERWRITE_MODE)
    conf.set(OVERWRITE_MODE, "static")
    try:
        _side_by_side(lambda spec: overwrite_table(frames[spec], layers, spec), frames)
    finally:
        conf.set(OVERWRITE_MODE, previous)


def _side_by_side(write: Callable[[TableSpec], None], specs: Iterable[TableSpec]) -> None:
    """Submit one write per table from its own thread; the first failure is raised after all ended."""
    specs = list(specs)
    with ThreadPoolExecutor(len(specs)) as pool:
        for done in [pool.submit(write, spec) for spec in specs]:
            done.result()


def append_load(df: DataFrame, layers: Layers, spec: TableSpec, load_id: str) -> None:
    """Add the rows of one load as their own partition. Repeating a load replaces its rows, so a
    retried batch cannot be counted twice. A frame that came from no file may lack the file columns."""
    absent = {f.name: F.lit(None).cast(f.dataType) for f in spec.columns.fields
              if f.name in schemas.FILE_COLUMNS and f.name not in df.columns}
    rows = df.withColumns(absent).select(*spec.column_names, F.lit(load_id).alias(spec.partition))
    _replace(rows, layers.name(spec), "dynamic")


def upsert_table(source: DataFrame, layers: Layers, spec: TableSpec,
                 token: str | None = None, unique: bool = False) -> None:
    """Upsert into the month partitions that the source touches; the others are not read or written.

    Source and merged rows are first written to the shared folder under `token`, which names this
    one change. When a run dies while partitions are being replaced, a rerun with the same token
    finds the merged rows complete and only replaces again, so no row of a half-replaced month is
    lost. Only the list of months reaches the driver. With `unique` the caller asserts that no key is
    in the source twice, as after an aggregation by key, which spares the shuffle that checks it.
    """
    spark = source.sparkSession
    token = token or uuid.uuid4().hex
    stage = f"{shared_dir(spark)}/pricebeam/upserts/{layers.name(spec)}/{token}"
    table = stored_table(spark, layers, spec)
    target = spark.table(table)
    log = _log_for(spark, layers, spec, table)
    merged_path = f"{stage}/merged"
    if not path_exists(spark, f"{merged_path}/_SUCCESS"):
        keyed = source.select(*spec.column_names, month_of(spec).alias(spec.partition))
        keyed.write.mode("overwrite").parquet(f"{stage}/source")
        staged = spark.read.schema(keyed.schema).parquet(f"{stage}/source")
        months = _months(staged, spec) if unique else _touched_months(staged, spec)
        if not months:
            discard(spark, stage)
            return
        if log is not None:
            # The keys' months tell their partitions, so only the touched ones are compared.
            before, after = in_months(target, months).select(*spec.column_names), staged.select(*spec.column_names)
            log.record(keyed_changes(before, after, spec.key, whole=False), token)
        merged = upsert(in_months(target, months), staged, spec.key)
        merged.hint("rebalance", F.col(spec.partition)).write.mode("overwrite").parquet(merged_path)
    # Each merged file holds few months already, so replacing is a copy without a shuffle.
    merged = spark.read.schema(target.schema).parquet(merged_path)
    _replace(merged.select(*target.columns), table, "dynamic")
    if log is not None:
        log.publish(token)
    discard(spark, stage)


def upsert_tables(sources: Mapping[TableSpec, DataFrame], layers: Layers, token: str) -> None:
    """Upsert into several tables that do not read each other, from sources aggregated by key. The session
    must be in dynamic overwrite mode already, so that no writer has to change it under the others."""
    for frame in sources.values():
        if frame.sparkSession.conf.get(OVERWRITE_MODE).lower() != "dynamic":
            raise ValueError(f"set {OVERWRITE_MODE} to dynamic first")
    _side_by_side(lambda spec: upsert_table(sources[spec], layers, spec, token, unique=True), sources)


def _months(staged: DataFrame, spec: TableSpec) -> list:
    return [x[0] for x in staged.select(spec.partition).distinct().collect()]


def _touched_months(staged: DataFrame, spec: TableSpec) -> list:
    """The months of the staged rows; raises when one of them holds a complete key twice."""
    complete = reduce(Column.__and__, [F.col(k).isNotNull() for k in spec.key])
    keys = staged.groupBy(spec.partition, *spec.key).agg(F.count(F.when(complete, 1)).alias("n"))
    months = keys.groupBy(spec.partition).agg(F.max("n").alias("n")).collect()
    repeated = [m[spec.partition] for m in months if m["n"] > 1]
    if repeated:
        raise DuplicateKeyError(f"{spec.name}: duplicate upsert keys in {repeated[0]}")
    return [m[spec.partition] for m in months]

