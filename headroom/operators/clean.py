"""Cleaning: duplicates, gaps, outliers, warm-up rows."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P
from ..functions.numeric import clip
from ..functions.sizing import stored
from .knn import nearest_values
from .quantiles import exact_quantiles, melt
from .rolling import capped, moments, with_chunk_kernel
from .segments import (
    BUILT,
    attach_entity_stats,
    last_before,
    neighbours,
    row_positions,
    with_position,
)


def dedup_by_key(df: DataFrame, keys: Sequence[str] = (P.ENTITY, P.TS), tiebreak: Sequence[str] = ()) -> DataFrame:
    """First row of each key in ``tiebreak`` order.

    An aggregate rather than a window: copies are reduced before the shuffle, so a key that
    holds a large share of all rows costs one row per map task.
    """
    rest = [c for c in df.columns if c not in keys and c not in tiebreak]
    first = F.min(F.struct(*[F.col(c) for c in tiebreak], *[F.col(c) for c in rest])).alias("_first")
    kept = df.groupBy(*keys).agg(first)
    return kept.select(*keys, "_first.*").select(df.columns)


def duplicates_removed(df: DataFrame, keys: Sequence[str] = (P.ENTITY, P.TS)) -> DataFrame:
    """Rows in, distinct keys, rows a deduplication removes."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.sum("_n").alias("rows_in"), F.count(F.lit(1)).alias("rows_out"),
        (F.sum("_n") - F.count(F.lit(1))).alias("duplicates_removed"),
    )


def fill_forward_backward(
    df: DataFrame, columns: Sequence[str], entity: str = P.ENTITY, ts: str = P.TS,
    method: str = "both", order: Sequence[str] | None = None, hours: int = P.SEGMENT_HOURS,
) -> DataFrame:
    """Carry the last value forward, then the next value backward (``forward``, ``backward``, ``both``)."""
    filled = neighbours(
        df, [entity], ts, {c: F.col(c) for c in columns}, order,
        before=None if method == "backward" else "_prev_",
        after=None if method == "forward" else "_next_", hours=hours,
    )
    pick = {"forward": ("_prev_",), "backward": ("_next_",), "both": ("_prev_", "_next_")}[method]
    out = filled.withColumns({c: F.coalesce(*[F.col(f"{p}{c}") for p in pick]) for c in columns})
    return out.select(df.columns)


def interpolate_linear(
    df: DataFrame, columns: Sequence[str], entity: str = P.ENTITY, ts: str = P.TS,
    regular: bool = False, edges: str = "both", hours: int = P.SEGMENT_HOURS,
) -> DataFrame:
    """Linear between the neighbours by row position; the edges take the nearest value.

    ``edges='forward'`` leaves a leading gap missing. ``regular`` reads positions from the date of a
    gap-free daily panel and saves the numbering pass (``row_positions``).
    """
    placed = row_positions(df, [entity], ts, regular, [ts, *columns], hours)
    held = {}
    for c in columns:
        held |= {f"v_{c}": F.col(c), f"p_{c}": F.when(F.col(c).isNotNull(), F.col("_pos"))}
    near = neighbours(placed, [entity], ts, held, ["_pos"] if regular == BUILT else [ts, "_pos"], hours=None if regular == BUILT else hours)
    made = {}
    for c in columns:
        pv, pp = F.col(f"_prev_v_{c}"), F.col(f"_prev_p_{c}")
        nv, np_ = F.col(f"_next_v_{c}"), F.col(f"_next_p_{c}")
        inner = pv + (nv - pv) * ((F.col("_pos") - pp) / (np_ - pp))
        edge = F.coalesce(pv, nv) if edges == "both" else pv
        made[c] = F.when(F.col(c).isNotNull(), F.col(c)).when(pv.isNotNull() & nv.isNotNull(), inner).otherwise(edge)
    return near.withColumns(made).select(df.columns)


def interpolate_then_edges(
    df: DataFrame, columns: Sequence[str], entity: str = P.ENTITY, ts: str = P.TS, hours: int = P.SEGMENT_HOURS,
) -> DataFrame:
    """Interpolate, then backward and forward fill. Both-edge interpolation already ends there."""
    return interpolate_linear(df, columns, entity, ts, edges="both", hours=hours)


def fill_fallback(
    df: DataFrame, columns: Sequence[str], entity: str = P.ENTITY, ts: str = P.TS,
    scope: str = "entity", hours: int = P.SEGMENT_HOURS,
) -> DataFrame:
    """Forward fill, then 0. ``scope='table'`` fills across servers in (server, time) order."""
    own = fill_forward_backward(df, columns, entity, ts, "forward", hours=hours)
    if scope == "table":
        last = {c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(ts))).alias(f"_t_{c}") for c in columns}
        ends = df.groupBy(entity).agg(*last.values())
        carried = last_before(ends, entity, {f"_k_{c}": f"_t_{c}" for c in columns})
        own = attach_entity_stats(own, carried, [entity], ts).withColumns(
            {c: F.coalesce(F.col(c), F.col(f"_k_{c}")) for c in columns}
        )
    return own.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in columns}).select(df.columns)


def fill_by_type(df: DataFrame) -> DataFrame:
    """Numbers become 0, strings 'Unknown'."""
    numbers = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    strings = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    out = df.na.fill(0, numbers) if numbers else df
    return out.na.fill("Unknown", strings) if strings else out


def impute_median(df: DataFrame, columns: Sequence[str], entity: str = P.ENTITY, ts: str = P.TS) -> DataFrame:
    """Missing values take their server's median (exact, from bracketed ranks)."""
    long = melt(df.select(entity, *columns), columns, (entity,))
    mid = exact_quantiles(long, (entity, "metric"), "value", [0.5])
    wide = mid.groupBy(entity).agg(*[F.max(F.when(F.col("metric") == c, F.col("quantile"))).alias(f"_m_{c}") for c in columns])
    out = attach_entity_stats(df, wide, [entity], ts)
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"_m_{c}")) for c in columns}).select(df.columns)


def winsorize_rolling_z(
    df: DataFrame, columns: Sequence[str], entity: str = P.ENTITY, ts: str = P.TS,
    window: int = P.OUTLIER_WINDOW, z: float = P.OUTLIER_Z, regular: bool = False,
) -> DataFrame:
    """Cap values far from the trailing window (current row included)."""
    def kernel(values):
        return {c: capped(values[c], window, z) for c in columns}

    return with_chunk_kernel(df, kernel, columns, columns, window - 1, entity, ts, regular)


def rolling_anomaly_score(
    df: DataFrame, columns: Sequence[str], entity: str = P.ENTITY, ts: str = P.TS,
    window: int = P.OUTLIER_WINDOW, regular: bool = False,
) -> DataFrame:
    """Add ``<metric>_anomaly_score``: z against the trailing window, without the cap; NULL on flat windows."""
    def kernel(values):
        out = {}
        for c in columns:
            _, mean, std = moments(values[c], [window])[window]
            out[f"{c}_anomaly_score"] = (values[c] - mean) / np.where(std > 1e-9, std, np.nan)
        return out

    return with_chunk_kernel(df, kernel, columns, [f"{c}_anomaly_score" for c in columns], window - 1, entity, ts, regular)


def zscore_flags(df: DataFrame, columns: Sequence[str], threshold: float = 3.0) -> DataFrame:
    """Whole-table z-score booleans; a constant column never flags."""
    stats = df.agg(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_samp(c).alias(f"s_{c}") for c in columns])
    made = {}
    for c in columns:
        mean, spread = stats.select(f"m_{c}").scalar(), stats.select(f"s_{c}").scalar()
        z = F.abs(F.try_divide(F.col(c) - mean, F.when(spread > 0, spread)))
        made[f"is_outlier_{c}"] = F.coalesce(z > threshold, F.lit(False))
    return df.withColumns(made)


def warmup_drop(
    df: DataFrame, rows: int, entity: str = P.ENTITY, ts: str = P.TS, hours: int = P.SEGMENT_HOURS,
) -> DataFrame:
    """Drop the first ``rows`` rows of each server."""
    return with_position(df, [entity], ts, name="_pos", hours=hours).filter(F.col("_pos") > rows).drop("_pos")


def clean_panel_legacy(df: DataFrame, tiebreak: Sequence[str], entity: str = P.ENTITY, ts: str = P.TS) -> DataFrame:
    """Deduplicate, fill numbers forward and backward per server, fill the rest by type."""
    one = dedup_by_key(df, (entity, ts), tiebreak)
    numbers = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return fill_by_type(fill_forward_backward(one, numbers, entity, ts))


def clean_numeric(
    df: DataFrame, columns: Sequence[str], lo: float = 0.0, hi: float = 1.0, method: str = "ffill",
    entity: str = P.ENTITY, ts: str = P.TS,
) -> DataFrame:
    """Clamp, then fill per server: ``ffill``, ``bfill`` or ``interpolate`` (leading gap stays)."""
    held = df.withColumns({c: clip(c, lo, hi) for c in columns})
    if method == "interpolate":
        return interpolate_linear(held, columns, entity, ts, edges="forward")
    if method in ("ffill", "bfill"):
        return fill_forward_backward(held, columns, entity, ts, "forward" if method == "ffill" else "backward")
    return held


def quality_flag(df: DataFrame, metric: str, imputed: DataFrame, flagged: str, entity: str = P.ENTITY, ts: str = P.TS) -> DataFrame:
    """0 good, 1 imputed, 2 flagged: ``df`` before, ``imputed`` after imputation with a boolean ``flagged``."""
    before = df.select(F.col(entity), F.col(ts), F.col(metric).isNull().alias("_was_null"))
    both = imputed.join(before, [entity, ts], "left")
    mark = F.when(F.col(flagged), 2).when(F.col("_was_null") & F.col(metric).isNotNull(), 1).otherwise(0)
    return both.withColumn("quality_flag", mark).drop("_was_null")


def impute_knn(
    df: DataFrame, features: Sequence[str], k: int = P.KNN_NEIGHBOURS,
    entity: str = P.ENTITY, ts: str = P.TS, cell_rows: int = 256, hours: int = P.SEGMENT_HOURS,
) -> DataFrame:
    """Missing values take the mean of the ``k`` nearest rows of the same server that have them.

    Distance over co-present features, scaled up for the absent ones; ties by row position; the
    server's column mean where no row is comparable. The neighbours are exact, found by a grid of about
    ``cell_rows`` rows a cell (``knn.py``): work grows with the rows, and no server is held in one task.
    """
    features = list(features)
    # numbered once: rows of equal time must keep their number
    placed = stored(with_position(df, [entity], ts, name="_rid", hours=hours), "numbered")
    near = nearest_values(placed, features, k, entity, cell_rows)
    means = near.groupBy(entity, "_rid").agg(*[F.avg(F.when(F.col("_feature") == i, F.col("_value"))).alias(f"_k_{c}") for i, c in enumerate(features)])
    fallback = placed.groupBy(entity).agg(*[F.avg(c).alias(f"_a_{c}") for c in features])
    out = attach_entity_stats(placed, fallback, [entity], "_rid").join(means, [entity, "_rid"], "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"_k_{c}"), F.col(f"_a_{c}")) for c in features}).select(df.columns)
