"""Shared-folder staging: write a result once, then read it as often as needed."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a private folder only for local masters."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    private = tempfile.mkdtemp(prefix="riskloom-")
    atexit.register(shutil.rmtree, private, ignore_errors=True)
    context.setCheckpointDir(private)
    return context.getCheckpointDir()


def staging_root(spark: SparkSession) -> str:
    """Folder of what this application stages."""
    return f"{shared_folder(spark)}/riskloom-staged/{spark.sparkContext.applicationId}"


#: Spark deletes the shuffle files of a query at its end while this is set.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and return the table read back.

    Used where several passes need the same intermediate result: the source is
    scanned once, lineage ends at the files, and a lost executor costs a re-read.
    Nothing reads the shuffle files of the write afterwards, so they go at once.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        writer.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table._staged_at = path
    return table


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more; tables from elsewhere are left alone."""
    for table in tables:
        if path := getattr(table, "_staged_at", None):
            _delete(table.sparkSession, path)


def clear_staged(spark: SparkSession) -> None:
    """Delete what this application staged; call it when no staged table is in use."""
    _delete(spark, staging_root(spark))
