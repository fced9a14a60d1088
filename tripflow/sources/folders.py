"""Folders that every executor can reach."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder name under the session's ``spark.checkpoint.dir``.

    Only a local session may go without that setting; its warehouse then holds the folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None) or "spark-warehouse"
        root = f"{warehouse.rstrip('/')}/runs"
    return f"{root.rstrip('/')}/tripflow/{purpose}-{uuid4().hex}"


def ensure_folder(spark: SparkSession, path: str) -> str:
    """Makes a folder, on whichever file system the path names, unless there is one.

    A path with wildcards is left alone.
    """
    gateway = spark.sparkContext._jvm
    folder = gateway.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.globStatus(folder) is None:
        system.mkdirs(folder)
    return path


def has_sink_log(spark: SparkSession, path: str) -> bool:
    """Whether a streaming file sink wrote the table."""
    gateway = spark.sparkContext._jvm
    log = gateway.org.apache.hadoop.fs.Path(path, "_spark_metadata")
    return log.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(log)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match a pattern."""
    gateway = spark.sparkContext._jvm
    wanted = gateway.org.apache.hadoop.fs.Path(pattern)
    system = wanted.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [str(status.getPath().toString()) for status in system.globStatus(wanted) or []]
