"""Grouped reports, profiles and the tables behind charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params as P
from ..functions import calendar as C
from .quantiles import exact_quantiles, melt, quantile_columns

# fixed values: server-type profiles (type, name, base CPU %, base memory %, base disk %,
# CPU-memory correlation, spike probability, business-hours factor, weekend factor)
PROFILES = (
    ("web", "Web Server", 45.0, 35.0, 20.0, 0.5, 0.03, 1.6, 0.5),
    ("database", "Database Server", 35.0, 70.0, 55.0, 0.6, 0.01, 1.3, 0.7),
    ("application", "Application Server", 50.0, 55.0, 30.0, 0.7, 0.02, 1.5, 0.6),
    ("batch", "Batch Processing Server", 30.0, 45.0, 40.0, 0.4, 0.08, 0.8, 1.2),
)
_PROFILE_SCHEMA = (
    "server_type string, profile_name string, base_cpu double, base_memory double, base_disk double, "
    "cpu_memory_corr double, spike_probability double, business_hours_factor double, weekend_factor double"
)


def profile_catalogue(spark: SparkSession) -> DataFrame:
    """The four server-type profiles, a fixed table."""
    return spark.createDataFrame([*PROFILES], _PROFILE_SCHEMA)


def with_load_factor(df: DataFrame, server_type: str = "server_type", ts: str = P.TS) -> DataFrame:
    """``load_factor``: business-hours times weekend multiplier of the row's server type."""
    four = F.broadcast(profile_catalogue(df.sparkSession).select(
        F.col("server_type").alias(server_type), "business_hours_factor", "weekend_factor"))
    joined = df.join(four, server_type, "left")
    busy = F.when(F.hour(F.col(ts)).between(9, 17), F.col("business_hours_factor")).otherwise(1.0)
    rest = F.when(C.weekday(ts) >= 5, F.col("weekend_factor")).otherwise(1.0)
    return joined.withColumn("load_factor", busy * rest).drop("business_hours_factor", "weekend_factor")


def mean_by_group(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Mean per group, highest first."""
    out = df.groupBy(*keys).agg(F.avg(column).alias(f"mean_{column}"), F.count(F.lit(1)).alias("rows"))
    return out.orderBy(F.desc(f"mean_{column}"), *keys)


def monthly_profile(df: DataFrame, column: str, keys: Sequence[str] = (P.ENTITY,), ts: str = P.TS) -> DataFrame:
    """Mean per month beside the mean of the months."""
    per = df.groupBy(*keys, F.month(F.to_date(F.col(ts))).alias("month")).agg(F.avg(column).alias("mean_value"))
    whole = per.groupBy(*keys).agg(F.avg("mean_value").alias("mean_of_months"))
    return per.join(whole, list(keys))


def weekly_profile(df: DataFrame, column: str, keys: Sequence[str] = (), ts: str = P.TS) -> DataFrame:
    return df.groupBy(*keys, C.weekday(ts).alias("weekday")).agg(F.avg(column).alias("mean_value"))


def servers_per_group(df: DataFrame, keys: Sequence[str], entity: str = P.ENTITY) -> DataFrame:
    """Distinct servers per group and their share of all."""
    pairs = df.select(*keys, entity).distinct()
    per = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("servers"))
    total = per.agg(F.sum("servers")).scalar()
    return per.withColumn("share_pct", F.col("servers") * 100.0 / total)


def multi_agg(df: DataFrame, keys: Sequence[str], spec: dict[str, Sequence[str]]) -> DataFrame:
    """Several aggregates per column with names ``<column>_<aggregate>``."""
    fn = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "sum": F.sum, "count": F.count}
    return df.groupBy(*keys).agg(*[fn[a](c).alias(f"{c}_{a}") for c, names in spec.items() for a in names])


def extremes(df: DataFrame, key: str, value: str) -> DataFrame:
    """The keys with the lowest and highest value; ties go to the first key."""
    return df.agg(
        F.min(F.struct(F.col(value).alias("v"), F.col(key).alias("k"))).alias("_lo"),
        F.min(F.struct((-F.col(value)).alias("v"), F.col(key).alias("k"))).alias("_hi"),
    ).select(
        F.col("_lo.k").alias("min_key"), F.col("_lo.v").alias("min_value"),
        F.col("_hi.k").alias("max_key"), (-F.col("_hi.v")).alias("max_value"),
    )


def box_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Minimum, exact quartiles and maximum per metric."""
    q = exact_quantiles(melt(df, columns), ["metric"], "value", [0.0, 0.25, 0.5, 0.75, 1.0])
    return quantile_columns(q, ["metric"], {0.0: "min", 0.25: "q1", 0.5: "median", 0.75: "q3", 1.0: "max"})


def histogram(df: DataFrame, columns: Sequence[str], lo: float = 0.0, hi: float = 100.0, bins: int = 20) -> DataFrame:
    """Counts per equal-width bin; values below ``lo`` are in bin 0, from ``hi`` up in bin ``bins + 1``."""
    long = melt(df, columns).filter(F.col("value").isNotNull())
    b = F.expr(f"width_bucket(value, {float(lo)}D, {float(hi)}D, {int(bins)})")
    return long.groupBy("metric", b.alias("bin")).agg(F.count(F.lit(1)).alias("rows"))


def risk_by_dimension(risky: DataFrame, metadata: DataFrame, dimension: str, entity: str = P.ENTITY) -> DataFrame:
    """Risky servers with their group and the group's count; one row per server, never a list per group."""
    placed = risky.select(entity).distinct().join(metadata.select(entity, dimension), entity)
    per = placed.groupBy(dimension).agg(F.count(F.lit(1)).alias("risky_servers"))
    return placed.join(per, dimension).select(dimension, entity, "risky_servers")


def hot_last_days(df: DataFrame, metric: str, threshold: float, days: int = 30, entity: str = P.ENTITY, ts: str = P.TS) -> DataFrame:
    """Servers with a value above the threshold in the last ``days`` days of the table."""
    end = df.agg(F.max(F.to_date(F.col(ts)))).scalar()
    recent = df.filter(F.to_date(F.col(ts)) > F.date_sub(end, days)).filter(F.col(metric) > threshold)
    return recent.groupBy(entity).agg(F.max(metric).alias("max_value"), F.count(F.lit(1)).alias("hot_days"))


def next_days_by_group(forecast: DataFrame, metadata: DataFrame, dimension: str, entity: str = P.ENTITY) -> DataFrame:
    """Mean future prediction per group."""
    per = forecast.filter("is_future").groupBy(entity).agg(F.sum("predicted").alias("_s"), F.count("predicted").alias("_n"))
    return per.join(metadata.select(entity, dimension), entity).groupBy(dimension).agg(
        (F.sum("_s") / F.sum("_n")).alias("mean_predicted"), F.count(F.lit(1)).alias("servers"))
