"""Regular time axes: spines, daily resampling, percentile roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from .quantiles import exact_quantiles, melt, quantile_columns

_AGGREGATES = {"max": F.max, "min": F.min, "mean": F.avg, "sum": F.sum, "count": F.count}


def entity_days(df: DataFrame, entity: str = P.ENTITY, ts: str = P.TS) -> DataFrame:
    """Every day between the first and last day of each entity."""
    d = F.to_date(F.col(ts))
    ends = df.groupBy(entity).agg(F.min(d).alias("_lo"), F.max(d).alias("_hi"))
    return ends.select(entity, F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))).alias(ts))


def fill_calendar(daily: DataFrame, entity: str = P.ENTITY, ts: str = P.TS) -> DataFrame:
    """Add the missing days of a daily table (unique entity and day) as NULL rows.

    Only the rows there are get shuffled: each then fills the days up to the next one of its entity. An entity
    has at most as many rows as the calendar has days, so they lie together, which the series operators that
    follow need anyway.
    """
    day = F.to_date(F.col(ts))
    after = F.lead(day).over(Window.partitionBy(entity).orderBy(ts))
    own = daily.filter(day.isNotNull()).withColumn("_upto", F.greatest(day, F.date_sub(after, 1)))
    days = own.withColumn("_day", F.explode(F.sequence(day, F.coalesce("_upto", day), F.expr("INTERVAL 1 DAY"))))
    here = F.col(entity).isNotNull() & (F.col("_day") == F.col(ts))
    return days.select(*[F.col(c) if c == entity else F.col("_day").alias(c) if c == ts else F.when(here, F.col(c)).alias(c) for c in daily.columns])


def resample_daily(
    df: DataFrame,
    columns: Sequence[str],
    how: str = "max",
    entity: str = P.ENTITY,
    ts: str = P.TS,
) -> DataFrame:
    """Daily rows per entity; empty days are NULL for max, min and mean, 0 for sum and count."""
    agg = _AGGREGATES[how]
    daily = df.groupBy(entity, F.to_date(F.col(ts)).alias(ts)).agg(*[agg(c).alias(c) for c in columns])
    full = fill_calendar(daily, entity, ts)
    return full.na.fill(0, list(columns)) if how in ("sum", "count") else full


def percentile_rollup(
    df: DataFrame,
    columns: Sequence[str],
    prob: float = 0.95,
    entity: str = P.ENTITY,
    ts: str = P.TS,
) -> DataFrame:
    """Exact percentile per entity and day from finer samples, safe for a hot entity-day."""
    day = F.to_date(F.col(ts)).alias(ts)
    long = melt(df.select(entity, day, *columns), columns, (entity, ts))
    got = exact_quantiles(long, (entity, ts, "metric"), "value", [prob])
    picks = [F.max(F.when(F.col("metric") == c, F.col("quantile"))).alias(c) for c in columns]
    return got.groupBy(entity, ts).agg(*picks)


def fleet_spine(df: DataFrame, entity: str = P.ENTITY, ts: str = P.TS) -> DataFrame:
    """Every entity on every day between the first and last day of the whole table."""
    d = F.to_date(F.col(ts))
    span = df.agg(F.min(d).alias("lo"), F.max(d).alias("hi"))
    axis = F.sequence(span.select("lo").scalar(), span.select("hi").scalar(), F.expr("INTERVAL 1 DAY"))
    return df.select(entity).distinct().select(entity, F.explode(axis).alias(ts))


__all__ = ["entity_days", "fill_calendar", "resample_daily", "percentile_rollup", "fleet_spine", "quantile_columns"]
