"""Risk flags, under-use, clusters, savings and reports on forecast tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import calendar as C
from ..functions.numeric import level, truth
from ..functions.sizing import stored
from .segments import attach_entity_stats


def risk_flags(df: DataFrame, threshold: float = P.RISK_THRESHOLD, value: str = "predicted", high: float = P.HIGH_FACTOR) -> DataFrame:
    """``risk_flag`` above the threshold; ``risk_level`` high above ``high`` times it, medium, low."""
    return df.withColumns({
        "risk_flag": truth(F.col(value) > threshold),
        "risk_level": level(value, [(threshold * high, "high"), (threshold, "medium")], "low"),
    })


def risk_flags_multi(df: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """A flag per metric and ``any_risk``."""
    made = {f"{c}_risk": truth(F.col(c) > t) for c, t in thresholds.items()}
    return df.withColumns(made).withColumn("any_risk", reduce(lambda a, b: a | b, [F.col(n) for n in made]))


def _of_model(model: str | None) -> Column:
    return F.lit(True) if model is None else F.col("model") == model


def seasonal_peak(df: DataFrame, model: str | None = None, threshold: float | None = None, entity: str = P.ENTITY, ts: str = P.TS) -> DataFrame:
    """Month, quarter-end and holiday marks, and the server's highest prediction on marked future days.

    With ``threshold`` the peak is also given in percent of it.
    """
    marks = {"month": F.month(F.to_date(F.col(ts))), "is_eoq": C.is_quarter_end(ts) == 1, "is_holiday": C.is_holiday(ts)}
    rows = df.withColumns(marks)
    hit = F.col("is_future") & _of_model(model) & (F.col("is_eoq") | (F.col("is_holiday") == 1))
    peaks = rows.filter(hit).groupBy(entity).agg(F.max("predicted").alias("seasonal_peak_risk"))
    out = attach_entity_stats(rows, peaks, [entity], ts)
    if threshold is not None:
        out = out.withColumn("seasonal_peak_pct", F.col("seasonal_peak_risk") / threshold * 100)
    return out


def underutilized(
    df: DataFrame, threshold: float = P.UNDERUSE_THRESHOLD, model: str | None = None, entity: str = P.ENTITY, ts: str = P.TS,
) -> DataFrame:
    """``is_underutilized`` on all rows of servers whose mean future prediction is below the threshold."""
    means = df.filter(F.col("is_future") & _of_model(model)).groupBy(entity).agg(F.avg("predicted").alias("_mean"))
    low = means.filter(F.col("_mean") < threshold)
    out = attach_entity_stats(df, low, [entity], ts)
    return out.withColumn("is_underutilized", F.col("_mean").isNotNull()).drop("_mean")


def usage_profile(df: DataFrame, entity: str = P.ENTITY, value: str = "predicted") -> DataFrame:
    """Mean and deviation of the predictions per server: what the clusters are built on."""
    return df.groupBy(entity).agg(
        F.avg(value).alias(f"{value}_mean"), F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias(f"{value}_std"))


def cluster_servers(profile: DataFrame, columns: Sequence[str], k: int = P.CLUSTERS, seed: int = 42, entity: str = P.ENTITY) -> DataFrame:
    """k-means on the given columns; clusters are numbered by ascending centre of the first column.

    Every iteration and the labelling read the profile, one row per server, so it is stored first.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    points = VectorAssembler(inputCols=list(columns), outputCol="_x").transform(stored(profile, "profile"))
    model = KMeans(featuresCol="_x", predictionCol="_c", k=k, seed=seed).fit(points)
    centres = [float(c[0]) for c in model.clusterCenters()]
    rank = {c: r for r, c in enumerate(sorted(range(len(centres)), key=lambda i: centres[i]))}
    label = reduce(lambda e, cr: e.when(F.col("_c") == cr[0], cr[1]), rank.items(), F.when(F.lit(False), 0))
    return model.transform(points).withColumn("cluster", label).drop("_x", "_c")


def consolidation_savings(
    clustered: DataFrame, mean: str = "predicted_mean", cost: float = P.COST_PER_SERVER, share: float = P.SAVED_SHARE,
) -> DataFrame:
    """Servers in the cluster with the lowest mean, times cost, times the share saved."""
    sizes = clustered.groupBy("cluster").agg(F.avg(mean).alias("_m"), F.count(F.lit(1)).alias("_n"))
    low = sizes.agg(F.min(F.struct("_m", "cluster", "_n")).alias("_l"), F.sum("_n").alias("servers"))
    return low.select(
        F.col("_l.cluster").alias("cluster"), F.col("_l._n").alias("underutilized_count"),
        F.round(F.col("_l._n") * F.lit(cost) * F.lit(share), 2).alias("total_savings_usd"), "servers",
    )


def cluster_summary(clustered: DataFrame, mean: str = "predicted_mean", share: float = P.SAVED_SHARE) -> DataFrame:
    """Servers per cluster, their share of the fleet and the share saved if the lowest were consolidated."""
    sizes = clustered.groupBy("cluster").agg(F.count(F.lit(1)).alias("servers"), F.avg(mean).alias("mean_predicted"))
    total = clustered.agg(F.count(F.lit(1))).scalar()
    return sizes.withColumns({
        "fleet_share": F.col("servers") / total,
        "saved_share": F.when(F.col("cluster") == 0, F.lit(share) * F.col("servers") / total).otherwise(0.0),
    })


def risk_summary(df: DataFrame, savings: Column | None = None, entity: str = P.ENTITY) -> DataFrame:
    """Totals of a risk table: rows and distinct servers, flagged and under-used."""
    per = df.groupBy(entity).agg(
        F.count_if("risk_flag").alias("_r"), F.count_if("is_underutilized").alias("_u"))
    out = per.agg(
        F.count(F.lit(1)).alias("total_servers"), F.sum("_r").alias("flagged_rows"), F.count_if(F.col("_r") > 0).alias("flagged_servers"),
        F.sum("_u").alias("underutilized_rows"), F.count_if(F.col("_u") > 0).alias("underutilized_servers"),
    )
    return out if savings is None else out.withColumn("optimization_savings_usd", savings)


def breach_report(
    df: DataFrame, threshold: float = P.RISK_THRESHOLD, after: str | None = None, value: str = "predicted", entity: str = P.ENTITY, ts: str = P.TS,
) -> DataFrame:
    """Per server highest and mean prediction and days above the threshold; only servers with such days."""
    rows = df if after is None else df.filter(F.col(ts) >= F.lit(after).cast("date"))
    per = rows.groupBy(entity).agg(
        F.max(value).alias("max_predicted"), F.avg(value).alias("mean_predicted"), F.count_if(F.col(value) > threshold).alias("breach_days"))
    return per.filter(F.col("breach_days") > 0).orderBy(F.desc("max_predicted"), entity)


def flag_history_and_forecast(
    history: DataFrame, forecast: DataFrame, metric: str, threshold: float, value: str = "predicted", entity: str = P.ENTITY, ts: str = P.TS,
) -> DataFrame:
    """Rows of history and forecast above the threshold under one metric name, with ``risk_flag`` 1."""
    past = history.select(entity, ts, F.col(metric), F.lit(False).alias("is_future"))
    ahead = forecast.select(entity, ts, F.col(value).alias(metric), F.lit(True).alias("is_future"))
    return past.unionByName(ahead).filter(F.col(metric) > threshold).withColumn("risk_flag", F.lit(1))


def risk_category(df: DataFrame, very_high: float = 90.0, high: float = 80.0, low: float = 40.0, value: str = "predicted", entity: str = P.ENTITY) -> DataFrame:
    """Very high, high, under-used or normal by highest and mean prediction of the horizon."""
    per = df.filter("is_future").groupBy(entity).agg(F.max(value).alias("max_predicted"), F.avg(value).alias("mean_predicted"))
    label = (
        F.when(F.col("max_predicted") > very_high, "very_high").when(F.col("max_predicted") > high, "high")
        .when(F.col("mean_predicted") < low, "underutilized").otherwise("normal")
    )
    return per.withColumn("risk_category", label)


def risk_code_table(df: DataFrame, entity: str = P.ENTITY, ts: str = P.TS) -> DataFrame:
    """Long heat-map table: the first model's level per server and day as 0, 1, 2."""
    code = F.when(F.col("risk_level") == "high", 2).when(F.col("risk_level") == "medium", 1).otherwise(0)
    return df.groupBy(entity, ts).agg(F.min_by(code, F.col("model")).alias("risk_code"))


def risk_matrix(codes: DataFrame, days: Sequence | None = None, entity: str = P.ENTITY, ts: str = P.TS) -> DataFrame:
    """Wide heat map over a list of days; days without a row are 0. Without a list: all days of the table, a column each.

    A table of many days is better left in rows: see ``matrix_blocks``.
    """
    if days is None:
        days = [r[0] for r in codes.select(ts).distinct().orderBy(ts).collect()]  # one row per column made
    return codes.groupBy(entity).pivot(ts, list(days)).agg(F.first("risk_code")).na.fill(0)


BLOCK_DAYS = 64


def sparse_blocks(codes: DataFrame, value: str = "risk_code", entity: str = P.ENTITY, ts: str = P.TS, days: int = BLOCK_DAYS) -> DataFrame:
    """The server x day matrix as ``entity, block, cells``: one row for each server and block of ``days`` days that has a value.

    ``cells`` maps a day (since 1970) to its value, of several at one day the earliest, so a row holds at
    most ``days`` of them. There is no list of days, and none becomes a column. Rows without a day are left out.
    """
    day = F.unix_date(F.to_date(F.col(ts)))
    one = codes.where(F.col(ts).isNotNull()).groupBy(entity, day.alias("_day")).agg(F.min_by(value, ts).alias("_value"))
    block = F.floor(F.col("_day") / F.lit(days)).cast("int")
    return one.groupBy(entity, block.alias("block")).agg(F.map_from_entries(F.collect_list(F.struct("_day", "_value"))).alias("cells"))


def matrix_blocks(blocks: DataFrame, fill=None, entity: str = P.ENTITY) -> DataFrame:
    """The whole matrix, ``entity, block, days, values``: a row for each server and block, over the days that any server has.

    ``days`` and ``values`` are arrays of one length; cells without a value hold ``fill``. The axis, each day
    of the calendar once, is one value of the plan; rows meet their cells by server and block.
    """
    axis = blocks.select("block", F.explode(F.map_keys("cells")).alias("_day")).groupBy("block").agg(F.array_sort(F.collect_set("_day")).alias("days"))
    whole = axis.agg(F.collect_list(F.struct("block", "days")).alias("_axis")).select("_axis").scalar()
    grid = blocks.select(entity).distinct().select(entity, F.explode(whole).alias("_a")).select(entity, "_a.*")
    mine = blocks.select(F.col(entity).alias("_r"), F.col("block").alias("_block"), "cells")
    met = grid.join(mine, F.col(entity).eqNullSafe(F.col("_r")) & (F.col("block") == F.col("_block")), "left")
    values = F.transform("days", lambda d: F.coalesce(F.try_element_at("cells", d), F.lit(fill)))
    return met.select(entity, "block", "days", values.alias("values"))


def matrix_days(matrix: DataFrame, name: str = "risk_code", entity: str = P.ENTITY, ts: str = P.TS) -> DataFrame:
    """The cells of a matrix in long form."""
    cells = matrix.select(entity, F.explode(F.arrays_zip("days", "values")).alias("_c"))
    return cells.select(entity, F.date_from_unix_date("_c.days").alias(ts), F.col("_c.values").alias(name))
