"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str, cores: int | str = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster, pass in the cluster's own session."""
    scratch = tempfile.mkdtemp(prefix="pricebeam-")
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        "spark.checkpoint.dir": f"{scratch}/shared",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor sees: the cluster's `spark.checkpoint.dir`.

    Only a local session may fall back to a folder of its own; on a cluster a machine-local
    folder would be invisible to the other machines, so an unset one is an error there.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="pricebeam-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/pricebeam/{label}-{uuid.uuid4().hex}"


def on_filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    files, hadoop_path = on_filesystem(spark, path)
    return files.exists(hadoop_path)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Paths of the folders in a folder, by name; none if it does not exist."""
    files, hadoop_path = on_filesystem(spark, path)
    if not files.exists(hadoop_path):
        return []
    return sorted(x.getPath().toString() for x in files.listStatus(hadoop_path) if x.isDirectory())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of the library's own state, or a scratch copy."""
    files, hadoop_path = on_filesystem(spark, path)
    files.delete(hadoop_path, True)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch copy that is no longer needed. Only paths below the shared folder qualify."""
    if not path.startswith(f"{shared_dir(spark)}/pricebeam/"):
        raise ValueError(f"{path} is not a scratch path")
    remove_folder(spark, path)


def written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """A copy in the shared folder, for several readers, and its path for `discard`."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back: the plan is cut there, each row is computed
    once, and the copy survives lost executors."""
    return written(df, label)[0]
