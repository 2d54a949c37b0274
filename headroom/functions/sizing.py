"""Stored intermediate tables."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names for shared intermediate data; a local one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.gettempdir()
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_folder(spark)}/headroom-{name}-{os.urandom(6).hex()}"


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a table that several branches read to the shared folder and read it back.

    It cuts the lineage, survives lost executors, and later branches read only their columns.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def stored_by(df: DataFrame, key: str, name: str = "table") -> DataFrame:
    """Like ``stored``, in as many buckets of ``key`` as shuffles have partitions: what groups or joins by the key later moves no row.

    For keys that own few rows each: a bucket is read by one task.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    df.write.format("parquet").bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).option("path", path).saveAsTable(table)
    out = spark.table(table)
    out.stored_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more: all that was made from them has been written itself."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
