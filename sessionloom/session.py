"""Spark session settings and intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import gc
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession


def build_session(app_name: str = "sessionloom", **conf: str) -> SparkSession:
    """Session for the batch job; executor resources are left to spark-submit."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables, which every executor can reach.

    `spark.checkpoint.dir` if set, else the session's checkpoint folder, else the warehouse.
    None of these settings is changed.  A warehouse in a machine's own file system will do for a
    local session only.
    """
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if given:
        return given.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    local = spark.sparkContext.master.split("[")[0] == "local"
    if not local and (warehouse.startswith("file:") or ":" not in warehouse):
        raise ValueError(f"{warehouse} is no folder that executors share; set spark.checkpoint.dir")
    return warehouse


def _tables_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/sessionloom/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{_tables_dir(spark)}/{label}-{uuid.uuid4().hex}"


def drop_tables(spark: SparkSession) -> None:
    """Remove this application's intermediate tables; DataFrames built on them stop working."""
    files, path = _file_system(spark, _tables_dir(spark))
    files.delete(path, True)


def drop(*tables: DataFrame) -> None:
    """Remove the files of tables of `materialise` that nothing needs any more."""
    for table in tables:
        files, folder = _file_system(table.sparkSession, table.written_to)
        files.delete(folder, True)


def release(spark: SparkSession, *tables: DataFrame) -> None:
    """Remove tables of `materialise` that nothing needs any more, and shuffle files behind them.

    Spark removes shuffle files when the driver collects its garbage, which may be late.
    """
    drop(*tables)
    gc.collect()
    spark._jvm.System.gc()


def materialise(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write `df` once as Parquet in the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives Catalyst the true size of the table,
    so its broadcast threshold decides joins on what was measured.
    """
    path = new_path(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def bucketed(df: DataFrame, label: str, keys: list[str], buckets: int | None = None) -> DataFrame:
    """`materialise` by buckets of `keys`, sorted by them within each.

    Joins and groupings by these keys read buckets side by side and need no shuffle.  The buckets,
    by default the session's shuffle partitions, make one file each.  The catalog needs a table to
    write buckets; it is gone when this returns, the files stay as long as those of `materialise`.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path, name = new_path(spark, label), f"bucketed_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", path).format("parquet").saveAsTable(name)
    table = spark.table(name)
    table.written_to = path
    spark.sql(f"DROP TABLE {name}")
    return table


def observed(seen: Observation) -> dict[str, int]:
    """Sums and counts that a finished job observed; 0 is left out for those of no rows.

    If Spark finds beforehand that there are no rows, it drops what observes them, and asking
    fails.
    """
    try:
        return {name: value for name, value in seen.get.items() if value}
    except Py4JJavaError as error:
        if "AssertionError" not in str(error.java_exception):
            raise
        return {}


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def list_names(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the files and folders matching a path whose last part may hold a '*'."""
    files, path = _file_system(spark, pattern)
    return sorted(status.getPath().getName() for status in files.globStatus(path) or [])


def file_stamps(spark: SparkSession, pattern: str) -> dict[str, str]:
    """Length and time of change of the files matching a path whose last part may hold a '*'."""
    files, path = _file_system(spark, pattern)
    return {
        status.getPath().getName(): f"{status.getLen()}-{status.getModificationTime()}"
        for status in files.globStatus(path) or []
    }


def remove(spark: SparkSession, path: str) -> None:
    files, path = _file_system(spark, path)
    files.delete(path, True)


def exists(spark: SparkSession, path: str) -> bool:
    files, path = _file_system(spark, path)
    return files.exists(path)


def move(spark: SparkSession, path: str, to: str) -> None:
    files, path = _file_system(spark, path)
    if not files.rename(path, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"cannot move {path} to {to}")


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty marker file."""
    files, path = _file_system(spark, path)
    files.create(path, True).close()
