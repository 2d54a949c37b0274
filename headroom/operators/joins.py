"""Joins and set operations on panels and forecast tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from .segments import attach_entity_stats, overall_totals

# fixed values: fleet shares in assignment order; what is left over goes to the largest share
FLEET_SHARES = (("web", 0.35), ("application", 0.40), ("database", 0.15), ("batch", 0.10))


def join_metadata(df: DataFrame, metadata: DataFrame, entity: str = P.ENTITY) -> DataFrame:
    """Left join a dimension with one row per server; every metric row is kept.

    The optimiser broadcasts a small dimension by its size statistics; otherwise adaptive execution splits
    the rows of a server with a large share.
    """
    return df.join(metadata, entity, "left")


def join_forecast_actual(forecast: DataFrame, actual: DataFrame, target: str, how: str = "inner", keys: Sequence[str] = (P.ENTITY, P.TS)) -> DataFrame:
    """Attach actual values to forecasts; ``how='left'`` keeps the future rows with NULL."""
    return forecast.join(actual.select(*keys, F.col(target).alias("actual")), list(keys), how)


def mark_members(df: DataFrame, members: DataFrame, name: str, entity: str = P.ENTITY, ts: str = P.TS) -> DataFrame:
    """Boolean column: is the row's server in the set."""
    marks = members.select(entity).distinct().withColumn("_member", F.lit(True))
    out = attach_entity_stats(df, marks, [entity], ts)
    return out.withColumn(name, F.coalesce(F.col("_member"), F.lit(False))).drop("_member")


def assign_by_share(servers: DataFrame, shares: Sequence[tuple[str, float]] = FLEET_SHARES, entity: str = P.ENTITY, name: str = "server_type") -> DataFrame:
    """Give ``floor(n * share)`` servers, in id order, to each type and the rest to the largest share."""
    if abs(sum(s for _, s in shares) - 1.0) > 1e-9:
        raise ValueError("shares must sum to 1")
    ids = servers.select(entity).distinct()
    placed = overall_totals(ids, entity, {"_pos": F.lit(1).cast("long")})
    n = ids.agg(F.count(F.lit(1)).cast("double")).scalar()
    placed = placed.withColumn("_n", n)
    label: Column | None = None
    upto = F.lit(0).cast("long")
    for kind, share in shares:
        upto = upto + F.floor(F.col("_n") * F.lit(float(share))).cast("long")
        label = F.when(F.col("_pos") <= upto, kind) if label is None else label.when(F.col("_pos") <= upto, kind)
    most = max(shares, key=lambda s: s[1])[0]
    return placed.withColumn(name, label.otherwise(most)).select(entity, name)


def distinct_sorted(frames: Sequence[DataFrame], column: str) -> DataFrame:
    """Distinct values of a column over several tables, sorted."""
    out = frames[0].select(column)
    for f in frames[1:]:
        out = out.unionAll(f.select(column))
    return out.distinct().orderBy(column)


def first_entities(df: DataFrame, n: int, entity: str = P.ENTITY) -> DataFrame:
    """Rows of the first ``n`` servers by id."""
    ids = df.select(entity).distinct().orderBy(entity).limit(n)
    return df.join(ids, entity, "left_semi")
