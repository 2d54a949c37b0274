"""Readers and writers. A path's scheme chooses local disk or an object store."""

from __future__ import annotations

import fnmatch

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P


def read_panel(
    spark: SparkSession, path: str, kind: str | None = None, schema: T.StructType | str | None = None,
    ts: str = P.TS, parts: int | None = None,
) -> DataFrame:
    """Read Parquet, CSV (plain or gzip) or a JSON document by suffix or ``kind``.

    A gzip file cannot be split, so ``parts`` spreads its rows after the read.
    """
    bare = path.removesuffix("/").removesuffix(".gz")
    kind = kind or bare.rsplit(".", 1)[-1]
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if kind == "parquet":
        out = reader.parquet(path)
    elif kind == "csv":
        out = reader.option("header", True).csv(path)
        if ts in out.columns and isinstance(out.schema[ts].dataType, T.StringType):
            out = out.withColumn(ts, F.to_timestamp_ntz(ts))
    elif kind == "json":
        out = reader.option("multiLine", True).json(path)
    else:
        raise ValueError(f"unknown file kind {kind!r}")
    return out.repartition(parts) if parts else out


def read_object(spark: SparkSession, bucket: str, key: str, kind: str | None = None, scheme: str = "s3a", **options) -> DataFrame:
    """Read an object by bucket and key."""
    return read_panel(spark, f"{scheme}://{bucket}/{key}", kind, **options)


def dataset_times(spark: SparkSession, folder: str, pattern: str = "*", kind: str = "parquet") -> DataFrame:
    """Path and modification time of the datasets under a prefix whose names match a pattern.

    A dataset is a file ``<name>.<kind>`` (or ``.gz``), or a folder of that name with the files Spark wrote
    into it; its time is that of its newest file. Only the listing is read.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    dataset = F.regexp_extract("path", rf"^(.*?/[^/]*\.{kind}(?:\.gz)?)(?:/[^/]*)*$", 1)
    named = found.select(dataset.alias("path"), F.col("modificationTime").alias("modified")).where("path <> ''")
    wanted = F.regexp_extract("path", "([^/]*)$", 1).rlike(fnmatch.translate(pattern).replace(r"\z", r"\Z"))
    return named.where(wanted).groupBy("path").agg(F.max("modified").alias("modified"))


def latest_snapshot(spark: SparkSession, folder: str, pattern: str = "*", kind: str = "parquet", **options) -> DataFrame:
    """Read the whole dataset that was modified last; equal times go to the last name."""
    newest = dataset_times(spark, folder, pattern, kind).agg(F.max_by("path", F.struct("modified", "path"))).first()[0]
    if newest is None:
        raise FileNotFoundError(f"no {pattern} under {folder}")
    return read_panel(spark, newest, kind, **options)


def write_parquet(df: DataFrame, path: str, compress: bool = True) -> None:
    df.write.mode("overwrite").option("compression", "snappy" if compress else "none").parquet(path)


def write_csv(df: DataFrame, path: str, compress: bool = False, header: bool = True) -> None:
    out = df.write.mode("overwrite").option("header", header)
    (out.option("compression", "gzip") if compress else out).csv(path)


def write_partitioned(df: DataFrame, path: str, ts: str = P.TS) -> None:
    """Parquet in year/month/day folders.

    The rebalance gathers each day's rows, so a day has few files, and splits a day that is too large.
    """
    d = F.to_date(F.col(ts))
    parts = df.withColumns({"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d)})
    parts.hint("rebalance", "year", "month", "day").write.mode("overwrite").partitionBy("year", "month", "day").parquet(path)


def read_partitioned(spark: SparkSession, path: str, start: str, end: str, ts: str = P.TS) -> DataFrame:
    """Rows between two days, pruned to the folders of their years and months."""
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    month = F.col("year") * 12 + F.col("month")
    pruned = (month >= F.year(lo) * 12 + F.month(lo)) & (month <= F.year(hi) * 12 + F.month(hi))
    return spark.read.parquet(path).filter(pruned & F.to_date(F.col(ts)).between(lo, hi)).drop("year", "month", "day")


def write_summary(df: DataFrame, path: str) -> None:
    """A one-record summary as JSON."""
    df.write.mode("overwrite").json(path)


def sample_rows(df: DataFrame, keys: list[str], n: int = 200) -> DataFrame:
    """The first ``n`` rows in key order."""
    return df.orderBy(*keys).limit(n)


def date_stamped_name(df: DataFrame, stem: str = "raw_server_metrics", suffix: str = "parquet", ts: str = P.TS) -> DataFrame:
    """File name from the first and last day: ``<stem>_<yyyyMMdd>_to_<yyyyMMdd>.<suffix>``."""
    lo, hi = F.date_format(F.min(ts), "yyyyMMdd"), F.date_format(F.max(ts), "yyyyMMdd")
    return df.agg(F.concat(F.lit(f"{stem}_"), lo, F.lit("_to_"), hi, F.lit(f".{suffix}")).alias("file_name"))


def target_series(df: DataFrame, target: str, entity: str = P.ENTITY, ts: str = P.TS) -> DataFrame:
    """``item_id, timestamp, target_value`` for an outside forecaster; write it without a header."""
    return df.select(F.col(entity).alias("item_id"), F.date_format(F.col(ts), "yyyy-MM-dd").alias("timestamp"), F.col(target).alias("target_value"))
