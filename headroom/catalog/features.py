"""Window features and feature matrices."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean, features, segments
from ..operators.segments import BUILT
from ..sources import panels
from .base import METRICS, register, sql

_TWO = ["cpu_p95", "mem_p95"]
_W = "PARTITION BY server_id ORDER BY timestamp"


def _observed(spark, folder):
    return panels.supplier_metrics(spark, folder).select("server_id", "timestamp", *_TWO)


_LAGS = [f"{m}_lag_{k}d" for m in _TWO for k in (1, 3, 7, 14, 30)]


@register("lag_features", sql("metrics", f"""SELECT server_id, timestamp, {', '.join(f"lag({m}, {k}) OVER ({_W}) AS {m}_lag_{k}d" for m in _TWO for k in (1, 3, 7, 14, 30))} FROM metrics"""), _LAGS)
def lag_features(spark, folder):
    return features.lag_features(_observed(spark, folder), _TWO).drop(*_TWO)


_FN = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}
_ROLL = [f"{m}_roll_{s}_{n}d" for m in _TWO for n in (7, 30, 90) for s in _FN]


@register("rolling_stats", sql("metrics", "SELECT server_id, timestamp, " + ", ".join(
    f"{f}({m}) OVER ({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS {m}_roll_{s}_{n}d" for m in _TWO for n in (7, 30, 90) for s, f in _FN.items()) + " FROM metrics"), _ROLL, 8)
def rolling_stats(spark, folder):
    return features.rolling_stats(_observed(spark, folder), _TWO).drop(*_TWO)


@register("rolling_stats_regular", sql("cpu", "SELECT server_id, timestamp, " + ", ".join(
    f"{f}(cpu_p95) OVER ({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS cpu_p95_roll_{s}_{n}d" for n in (7, 90) for s, f in _FN.items()) + " FROM cpu"),
    [f"cpu_p95_roll_{s}_{n}d" for n in (7, 90) for s in _FN], 8)
def rolling_stats_regular(spark, folder):
    daily = panels.supplier_spine(spark, folder).select("server_id", "timestamp", "cpu_p95")
    filled = clean.interpolate_linear(daily, ["cpu_p95"], regular=BUILT)
    return features.rolling_stats(filled, ["cpu_p95"], (7, 90), regular=BUILT).drop("cpu_p95")


_FULL = [f"cpu_p95_rolling_{s}{n}" for n in (7, 14, 30) for s in ("mean", "std")]


@register("rolling_full_window", sql("sparse", "SELECT server_id, timestamp, " + ", ".join(
    f"CASE WHEN count(cpu_p95) OVER ({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) = {n} THEN {_FN[s]}(cpu_p95) OVER ({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) END AS cpu_p95_rolling_{s}{n}"
    for n in (7, 14, 30) for s in ("mean", "std")) + " FROM sparse"), _FULL, 5)
def rolling_full_window(spark, folder):
    return features.rolling_full_window(panels.supplier_sparse(spark, folder).select("server_id", "timestamp", "cpu_p95"), ["cpu_p95"]).drop("cpu_p95")


def _shifted(m, s, n, alias):
    w = f"({_W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count({m}) OVER {w} = {n} THEN {_FN[s]}({m}) OVER {w} END AS {alias}"


@register("rolling_shifted", sql("metrics", "SELECT server_id, timestamp, " + ", ".join(
    _shifted(m, s, n, f"{m}_roll_{s}_{n}d") for m in _TWO for s, n in (("mean", 7), ("mean", 30), ("std", 7))) + " FROM metrics"),
    [f"{m}_roll_{s}_{n}d" for m in _TWO for s, n in (("mean", 7), ("mean", 30), ("std", 7))], 5)
def rolling_shifted(spark, folder):
    return features.rolling_shifted(_observed(spark, folder), _TWO).drop(*_TWO)


@register("cumulative_sum", sql("metrics", "SELECT server_id, timestamp, " + ", ".join(f"sum({m}) OVER ({_W}) AS {m}_cumulative" for m in METRICS) + " FROM metrics"), [f"{m}_cumulative" for m in METRICS], 4)
def cumulative_sum(spark, folder):
    return features.cumulative_sum(panels.supplier_metrics(spark, folder)).drop(*METRICS)


@register("running_row_number", sql("metrics", f"SELECT server_id, timestamp, row_number() OVER ({_W}) AS position FROM metrics"))
def running_row_number(spark, folder):
    return segments.with_position(panels.supplier_metrics(spark, folder).select("server_id", "timestamp"), ["server_id"], "timestamp")


@register("one_hot_metadata", sql("panel", "SELECT server_id, timestamp, " + ", ".join(
    f"(business_unit = '{v}')::INT AS \"bus_{v}\"" for v in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")) + ", "
    + ", ".join(f"(criticality = '{v}')::INT AS \"cri_{v}\"" for v in ("High", "Low", "Medium")) + " FROM panel"))
def one_hot_metadata(spark, folder):
    panel = panels.supplier_panel(spark, folder).select("server_id", "timestamp", "business_unit", "criticality")
    dims = panels.supplier_dimension(spark, folder)
    labels = ["business_unit", "criticality"]
    return features.one_hot(panel, labels, features.categories(dims, labels))


_MATRIX_COLS = (
    [*METRICS] + [f"{m}_lag_{k}d" for m in METRICS for k in (1, 3, 7, 14, 30)] + [f"{m}_roll_{s}_{n}d" for m in METRICS for n in (7, 30, 90) for s in _FN]
    + [f"{m}_cumulative" for m in METRICS])
_CAL = ["day_of_week", "month", "is_weekend", "is_eoq_window", "is_holiday", "days_since_start"]


def _matrix_sql() -> str:
    from .base import eoq_sql, holiday_sql

    made = [f"lag({m}, {k}) OVER ({_W}) AS {m}_lag_{k}d" for m in METRICS for k in (1, 3, 7, 14, 30)]
    made += [f"{f}({m}) OVER ({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS {m}_roll_{s}_{n}d" for m in METRICS for n in (7, 30, 90) for s, f in _FN.items()]
    made += [f"sum({m}) OVER ({_W}) AS {m}_cumulative" for m in METRICS]
    cal = f"""isodow(timestamp) - 1 AS day_of_week, month(timestamp) AS month, (isodow(timestamp) >= 6)::INT AS is_weekend, {eoq_sql('timestamp')} AS is_eoq_window,
        {holiday_sql('timestamp')} AS is_holiday, datediff('day', (SELECT min(timestamp) FROM metrics), timestamp) AS days_since_start"""
    agg = ", ".join(f"avg({c}) AS {c}" for c in [*_MATRIX_COLS, *_CAL])
    hot = ", ".join(f"sum((criticality = '{v}')::INT)::BIGINT AS \"cri_{v}\"" for v in ("High", "Low", "Medium"))
    return sql("capped dim", f"""SELECT server_id, count(*) AS rows, {agg}, {hot} FROM (SELECT *, row_number() OVER ({_W}) AS rn, {cal}, {', '.join(made)} FROM capped)
        JOIN dim USING (server_id) WHERE rn > 90 GROUP BY 1""")


@register("feature_matrix", _matrix_sql(), [*_MATRIX_COLS, *_CAL], 6)
def feature_matrix(spark, folder):
    """The whole matrix, summed up per server so that the comparison stays readable."""
    dims = panels.supplier_dimension(spark, folder).select("server_id", "criticality")
    matrix = features.feature_matrix(panels.supplier_spine(spark, folder), dims, regular=BUILT)
    hot = [c for c in matrix.columns if c.startswith("cri_")]
    return matrix.groupBy("server_id").agg(
        F.count(F.lit(1)).alias("rows"), *[F.avg(c).alias(c) for c in [*_MATRIX_COLS, *_CAL]], *[F.sum(c).alias(c) for c in hot])


def _complete(cols):
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)


_LEG = [f"{m}_lag_{k}" for m in _TWO for k in (1, 7, 30)] + [f"{m}_roll_{s}" for m in _TWO for s in ("mean_7", "mean_30", "std_7")]


@register("feature_matrix_legacy", sql("metrics", f"""SELECT server_id, timestamp, {', '.join(_TWO + _LEG)}, isodow(timestamp) - 1 AS day_of_week, month(timestamp) AS month, quarter(timestamp) AS quarter,
    dayofyear(timestamp) AS day_of_year, (isodow(timestamp) >= 6)::INT AS is_weekend FROM (SELECT *, {', '.join(f"lag({m}, {k}) OVER ({_W}) AS {m}_lag_{k}" for m in _TWO for k in (1, 7, 30))},
    {', '.join(_shifted(m, s, n, f"{m}_roll_{s}_{n}") for m in _TWO for s, n in (("mean", 7), ("mean", 30), ("std", 7)))} FROM metrics) WHERE {_complete(_LEG)}"""), _TWO + _LEG, 5)
def feature_matrix_legacy(spark, folder):
    return features.legacy_features(_observed(spark, folder))


_SER = [f"cpu_p95_lag{k}" for k in (1, 7, 30)] + _FULL


@register("feature_series", sql("metrics", f"""SELECT server_id, timestamp, cpu_p95, {', '.join(_SER)}, CASE WHEN month(timestamp) % 3 = 0 AND timestamp = last_day(timestamp) THEN 1 ELSE 0 END AS is_quarter_end,
    isodow(timestamp) - 1 AS day_of_week, month(timestamp) AS month FROM (SELECT *, {', '.join(f"lag(cpu_p95, {k}) OVER ({_W}) AS cpu_p95_lag{k}" for k in (1, 7, 30))}, {', '.join(
    f"CASE WHEN count(cpu_p95) OVER ({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) = {n} THEN {_FN[s]}(cpu_p95) OVER ({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) END AS cpu_p95_rolling_{s}{n}"
    for n in (7, 14, 30) for s in ("mean", "std"))} FROM metrics) WHERE {_complete(_SER)}"""), ["cpu_p95", *_SER], 5)
def feature_series(spark, folder):
    return features.series_features(panels.supplier_metrics(spark, folder).select("server_id", "timestamp", "cpu_p95"), ["cpu_p95"])
