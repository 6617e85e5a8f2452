"""Staged tables: written once to shared storage, then read back.

A staged table cuts the lineage, so a lost executor costs a re-read and not a
re-run, and pins down values that a second run of the plan could change (ids
taken from the partition number). Spark also knows its exact size on disk, so
a join against it is broadcast only below ``spark.sql.autoBroadcastJoinThreshold``
and shuffled, with adaptive skew splitting, above it. A table of few rows goes to
about as many files as there are cores, however many shuffle partitions there are.
"""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for staged tables.

    ``spark.checkpoint.dir`` names it. Where that is unset, a folder of the
    warehouse is used, which all executors share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/gridpanel/{label}-{uuid.uuid4().hex}"


#: Rows of a file where the rows of a staged table are known to be few and short.
FILE_ROWS = 50_000


def files(spark: SparkSession, rows: int) -> int:
    """How many files short rows go to: one for each core at least, so that no task writes a whole table."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // FILE_ROWS))


def stage(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """rows: about as many as the table has at most, where that is known, its rows are short and its last step is cheap."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if rows is not None:
        df = df.coalesce(files(spark, rows))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def release(spark: SparkSession, path: str) -> bool:
    """Delete one staged table by its path (through the file system Spark uses for it)."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    """The folder's file system and its path there, for tasks; a plain path is a local one. Hadoop's other names of S3 are known."""
    for name in ("s3a://", "s3n://"):
        if folder.startswith(name):
            folder = "s3://" + folder[len(name) :]
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
