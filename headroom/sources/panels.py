"""Panels built from the star-schema tables.

``supplier_readings`` is the raw table (one row per line, several per supplier and day),
``supplier_panel`` its daily roll-up, ``event_readings`` a finer, shorter series per user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import padded_id
from ..operators.regularise import fill_calendar


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def supplier_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """One row per server: business unit, region and criticality."""
    supplier = table(spark, folder, "supplier")
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    bal = F.col("s_acctbal")
    tier = F.when(bal >= 6000, "High").when(bal >= 2000, "Medium").otherwise("Low")
    return (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            padded_id("s_suppkey").alias("server_id"),
            F.col("s_suppkey").alias("server_no"),
            F.col("r_name").alias("business_unit"),
            F.col("n_name").alias("region"),
            tier.alias("criticality"),
        )
    )


def supplier_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Raw readings; ``reading_id``, ``reading_line`` order the copies of one server and day."""
    line = table(spark, folder, "lineitem")
    return line.filter(F.col("l_suppkey").isNotNull() & F.col("l_shipdate").isNotNull()).select(
        padded_id("l_suppkey").alias("server_id"),
        F.to_date("l_shipdate").alias("timestamp"),
        F.col("l_orderkey").alias("reading_id"),
        F.col("l_linenumber").alias("reading_line"),
        (F.col("l_quantity") * 2.0).alias("cpu_p95"),
        (F.col("l_extendedprice") / 1050.0).alias("mem_p95"),
        (F.col("l_discount") * 1000.0 + 0.0).alias("disk_p95"),
        (F.col("l_tax") * 1000.0 + 0.0).alias("net_in_p95"),
        F.col("l_quantity").cast("double").alias("net_out_p95"),
    )


def supplier_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Daily metrics per server, without the dimension."""
    return supplier_readings(spark, folder).groupBy("server_id", "timestamp").agg(
        F.max("cpu_p95").alias("cpu_p95"),
        F.max("mem_p95").alias("mem_p95"),
        F.max("disk_p95").alias("disk_p95"),
        F.max("net_in_p95").alias("net_in_p95"),
        F.avg("net_out_p95").alias("net_out_p95"),
    )


def supplier_panel(spark: SparkSession, folder: str) -> DataFrame:
    """Observed days with metadata: the canonical ten-column panel."""
    dim = supplier_dimension(spark, folder).drop("server_no")
    return supplier_metrics(spark, folder).join(dim, "server_id").select(
        "server_id", "timestamp", "business_unit", "region", "criticality",
        "cpu_p95", "mem_p95", "disk_p95", "net_in_p95", "net_out_p95",
    )


def supplier_spine(spark: SparkSession, folder: str) -> DataFrame:
    """The daily metrics on a gap-free axis; unobserved days are NULL rows."""
    return fill_calendar(supplier_metrics(spark, folder))


def supplier_sparse(spark: SparkSession, folder: str) -> DataFrame:
    """Observed days where readings of returned lines carry no CPU and no memory value."""
    line = table(spark, folder, "lineitem")
    kept = F.col("l_returnflag") != "R"
    open_ = F.col("l_linestatus") == "O"
    return line.filter(F.col("l_suppkey").isNotNull() & F.col("l_shipdate").isNotNull()).groupBy(
        padded_id("l_suppkey").alias("server_id"), F.to_date("l_shipdate").alias("timestamp")
    ).agg(
        F.max(F.when(kept, F.col("l_quantity") * 2.0)).alias("cpu_p95"),
        F.max(F.when(open_, F.col("l_extendedprice") / 1050.0)).alias("mem_p95"),
        F.max(F.col("l_discount") * 1000.0 + 0.0).alias("disk_p95"),
    )


def event_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Samples of a user's metric at microsecond times."""
    events = table(spark, folder, "events")
    return events.filter(F.col("user_id").isNotNull() & F.col("ts").isNotNull()).select(
        padded_id("user_id", "USR-").alias("server_id"),
        F.col("ts").alias("timestamp"),
        F.col("event_id").alias("reading_id"),
        F.col("event_type").alias("event_type"),
        F.col("value").alias("cpu_p95"),
    )
