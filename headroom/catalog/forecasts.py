"""Splits, models, evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.sizing import scratch, stored
from ..operators import evaluate, forecast, joins
from ..operators.segments import BUILT
from ..operators.validate import describe_stats
from ..sources import panels
from .base import CUT, register, sql
from .shared import cpu_panel, forecasts

_FC = ["actual", "predicted", "yhat_lower", "yhat_upper"]


@register("split_chronological", sql("marked", "SELECT server_id, timestamp, y AS cpu_p95, CASE WHEN train THEN 'train' ELSE 'test' END AS split FROM marked"), ["cpu_p95"])
def split_chronological(spark, folder):
    return forecast.split_label(cpu_panel(spark, folder), CUT)


@register("split_fraction", sql("metrics", """SELECT server_id, timestamp, CASE WHEN row_number() OVER (PARTITION BY server_id ORDER BY timestamp) <= floor(count(*) OVER (PARTITION BY server_id) * 0.8::DOUBLE)
    THEN 'train' ELSE 'test' END AS split FROM metrics"""))
def split_fraction(spark, folder):
    return forecast.split_fraction(panels.supplier_metrics(spark, folder).select("server_id", "timestamp"), 0.8)


@register("history_gate", sql("metrics", f"""SELECT server_id, timestamp, cpu_p95 FROM metrics WHERE server_id IN (SELECT server_id FROM metrics GROUP BY 1
    HAVING count(*) FILTER (WHERE timestamp < DATE '{CUT}') >= 365 AND count(*) FILTER (WHERE timestamp >= DATE '{CUT}') > 0)"""), ["cpu_p95"])
def history_gate(spark, folder):
    return forecast.history_gate(panels.supplier_metrics(spark, folder).select("server_id", "timestamp", "cpu_p95"), CUT)


@register("future_spine", sql("metrics", """SELECT server_id, CAST(unnest(generate_series(CAST(max(timestamp) AS TIMESTAMP) + INTERVAL 1 DAY, CAST(max(timestamp) AS TIMESTAMP) + INTERVAL 90 DAY, INTERVAL 1 DAY)) AS DATE) AS timestamp
    FROM metrics GROUP BY server_id"""))
def future_spine(spark, folder):
    return forecast.future_days(panels.supplier_readings(spark, folder))


def _model(key: str, model: str):
    @register(key, sql(f"f_{model}", f"SELECT * FROM f_{model}"), _FC)
    def run(spark, folder):
        return forecasts(spark, folder, (model,))

    return run


forecast_weekday_mean = _model("forecast_weekday_mean", "baseline")
forecast_additive = _model("forecast_additive", "additive")
forecast_naive_last = _model("forecast_naive_last", "naive")
forecast_ses = _model("forecast_ses", "ses")
forecast_theta = _model("forecast_theta", "theta")


@register("forecast_table", sql("forecast5", "SELECT * FROM forecast5"), _FC, 5)
def forecast_table(spark, folder):
    return forecasts(spark, folder, forecast.MODELS)


@register("forecast_quantiles", sql("target wdmean train", """SELECT t.server_id, t.timestamp, m + q10 AS p10, m + q50 AS p50, m + q90 AS p90 FROM target t JOIN wdmean w ON t.server_id = w.server_id AND t.wd = w.wd
    JOIN (SELECT t.server_id, quantile_cont(y - m, 0.1) AS q10, quantile_cont(y - m, 0.5) AS q50, quantile_cont(y - m, 0.9) AS q90 FROM train t JOIN wdmean w ON t.server_id = w.server_id AND t.wd = w.wd GROUP BY 1) q
    ON t.server_id = q.server_id WHERE t.is_future"""), ["p10", "p50", "p90"])
def forecast_quantiles(spark, folder):
    return forecast.forecast_quantiles(cpu_panel(spark, folder), "cpu_p95", CUT)


_DF = sql("cpu", """SELECT server_id, n AS observations, b / sqrt((syy - b * sxy) / ((n - 2) * sxx)) AS df_statistic, coalesce(b / sqrt((syy - b * sxy) / ((n - 2) * sxx)) < -2.86, false) AS is_stationary FROM (
    SELECT server_id, regr_count(d, l) AS n, regr_slope(d, l) AS b, regr_sxx(d, l) AS sxx, regr_syy(d, l) AS syy, regr_sxy(d, l) AS sxy FROM (
    SELECT server_id, l, cpu_p95 - l AS d FROM (SELECT *, lag(cpu_p95) OVER (PARTITION BY server_id ORDER BY timestamp) AS l FROM cpu) WHERE l IS NOT NULL) GROUP BY 1)""")


@register("stationarity_df", _DF, ["df_statistic"], 5)
def stationarity_df(spark, folder):
    return forecast.stationarity(cpu_panel(spark, folder), "cpu_p95", regular=BUILT)


def _adf_sql(lags: int) -> str:
    """The same regressions by orthogonalising: what the changes before leave of level and change, one lag after the other."""
    back = ", ".join(f"lag(cpu_p95, {i}) OVER w AS l{i}" for i in range(1, lags + 2))
    names = ["x", "y", *[f"d{i}" for i in range(1, lags + 1)]]
    steps = [f"l AS (SELECT server_id, cpu_p95 AS l0, {back} FROM cpu WINDOW w AS (PARTITION BY server_id ORDER BY timestamp))",
             "raw AS (SELECT server_id, l1 AS x, l0 - l1 AS y" + "".join(f", l{i} - l{i + 1} AS d{i}" for i in range(1, lags + 1)) + f" FROM l WHERE l{lags + 1} IS NOT NULL)",
             "s0 AS (SELECT server_id, " + ", ".join(f"{c} - avg({c}) OVER (PARTITION BY server_id) AS {c}" for c in names) + " FROM raw)"]
    for k in range(1, lags + 1):
        left = ["x", "y", *[f"d{i}" for i in range(k + 1, lags + 1)]]
        steps.append(f"s{k} AS (SELECT server_id, " + ", ".join(
            f"{c} - sum({c} * d{k}) OVER (PARTITION BY server_id) / sum(d{k} * d{k}) OVER (PARTITION BY server_id) * d{k} AS {c}" for c in left) + f" FROM s{k - 1})")
    fits = " UNION ALL ".join(f"""SELECT server_id, {k} AS lags, count(*) AS n, sum(x * y) / sum(x * x) AS b, sum(x * x) AS sxx,
        sum(y * y) - sum(x * y) * sum(x * y) / sum(x * x) AS rss FROM s{k} GROUP BY 1""" for k in range(lags + 1))
    z = "CASE WHEN t <= -1.61 THEN 2.1659 + t * (1.4412 + t * 0.038269) ELSE 1.7339 + t * (0.93202 + t * (-0.12745 - 0.010368 * t)) END"
    tail = "exp(-z * z / 2) / sqrt(2 * pi()) * k * (0.319381530 + k * (-0.356563782 + k * (1.781477937 + k * (-1.821255978 + k * 1.330274429))))"
    return sql("cpu", "").rstrip() + ", " + ", ".join(steps) + f""" SELECT server_id, n AS observations, lags, t AS adf_statistic, p AS p_value, p < 0.05 AS is_stationary FROM (
        SELECT *, CASE WHEN t > 2.74 THEN 1.0 WHEN t < -18.83 THEN 0.0 WHEN z > 0 THEN 1 - {tail} ELSE {tail} END AS p FROM (SELECT *, 1 / (1 + 0.2316419 * abs(z)) AS k FROM (SELECT *, {z} AS z FROM (
        SELECT server_id, n, lags, b / sqrt(rss / (n - lags - 2) / sxx) AS t, row_number() OVER (PARTITION BY server_id ORDER BY n * ln(rss / n) + 2.0 * (lags + 2)) AS place FROM ({fits})) WHERE place = 1)))"""


@register("stationarity_adf", _adf_sql(5), ["adf_statistic", "p_value"], 5)
def stationarity_adf(spark, folder):
    """The augmented test with up to five earlier changes, as many as the AIC takes."""
    return forecast.augmented_stationarity(cpu_panel(spark, folder), "cpu_p95", 5, regular=BUILT)


@register("describe_by_model", sql("forecast", " UNION ALL ".join(f"""SELECT '{m}' AS model, 'predicted' AS metric, count(predicted) AS count, avg(predicted) AS mean, stddev_samp(predicted) AS std, min(predicted) AS min,
    max(predicted) AS max, quantile_cont(predicted, 0.05) AS p05, quantile_cont(predicted, 0.25) AS p25, quantile_cont(predicted, 0.5) AS p50, quantile_cont(predicted, 0.75) AS p75, quantile_cont(predicted, 0.95) AS p95
    FROM f_{m}""" for m in ("baseline", "additive"))), ["mean", "std", "min", "max", "p05", "p25", "p50", "p75", "p95"], 5)
def describe_by_model(spark, folder):
    return describe_stats(forecasts(spark, folder), ["predicted"], ["model"])


def _trees(spark, folder, kind: str):
    """Rows to score and a model fitted on the panel as it is now."""
    panel = cpu_panel(spark, folder)
    stats = forecast.tree_stats(panel, "cpu_p95", CUT)
    # fitting reads its table more than once, so it is stored first
    train = stored(forecast.tree_training(panel, "cpu_p95", CUT, stats=stats), "tree-training")
    return forecast.tree_rows(panel, "cpu_p95", CUT, stats=stats, salts=1), forecast.fit_trees(train, kind, *TREE_SIZE[kind])


# trees and depth; the same as the library's defaults
TREE_SIZE = {"random_forest": (150, 12), "gradient_boost": (150, 6)}


@register("forecast_random_forest")
def forecast_random_forest(spark, folder):
    rows, model = _trees(spark, folder, "random_forest")
    return forecast.score_model(model, rows, "random_forest")


@register("forecast_gradient_boost")
def forecast_gradient_boost(spark, folder):
    rows, model = _trees(spark, folder, "gradient_boost")
    return forecast.score_model(model, rows, "gradient_boost")


@register("score_model")
def score_model(spark, folder):
    """Save the fitted pipeline, load it, apply it to the future rows only."""
    from pyspark.ml import PipelineModel

    rows, model = _trees(spark, folder, "random_forest")
    path = scratch(spark, "model")
    model.write().overwrite().save(path)
    scored = forecast.score_model(PipelineModel.load(path), rows.filter("part = 'future'"), "random_forest")
    return scored.select("server_id", "timestamp", F.col("predicted").alias("yhat"))


@register("feature_importance")
def feature_importance(spark, folder):
    return forecast.feature_importance(spark, _trees(spark, folder, "random_forest")[1]).orderBy(F.desc("importance"), "feature")


@register("top_k_importance")
def top_k_importance(spark, folder):
    return feature_importance(spark, folder).limit(10)


@register("persist_model", sql("f_additive", "SELECT * FROM f_additive"), _FC)
def persist_model(spark, folder):
    """The additive coefficients written, read back and applied."""
    panel = cpu_panel(spark, folder)
    path = scratch(spark, "coefficients")
    forecast.save_coefficients(forecast.coefficients(forecast.cells(panel, "cpu_p95", CUT), CUT), path)
    return forecast.forecast_table(panel, "cpu_p95", CUT, models=("additive",), coef=forecast.load_coefficients(spark, path))


def _drift_line(rows):
    """A user's model: the straight line through a server's days, ten days ahead."""
    import numpy as np
    import pandas as pd

    x = np.arange(len(rows), dtype=float)
    slope, start = np.polyfit(x, rows["cpu_p95"].to_numpy(float), 1)
    last = pd.Timestamp(rows["timestamp"].iloc[-1])
    days = [(last + pd.Timedelta(days=h)).date() for h in range(1, 11)]
    return pd.DataFrame({"server_id": rows["server_id"].iloc[0], "timestamp": days, "predicted": start + slope * (len(rows) - 1 + np.arange(1, 11))})


@register("forecast_custom_group", sql("metrics", """SELECT server_id, CAST(last + CAST(h AS INTEGER) AS DATE) AS timestamp, a + b * (n - 1 + h) AS predicted FROM (
    SELECT server_id, max(timestamp) AS last, count(*) AS n, regr_slope(cpu_p95, x) AS b, regr_intercept(cpu_p95, x) AS a FROM (
    SELECT *, row_number() OVER (PARTITION BY server_id ORDER BY timestamp) - 1 AS x FROM metrics) GROUP BY 1), (SELECT unnest(generate_series(1, 10)) AS h)"""), ["predicted"], 5)
def forecast_custom_group(spark, folder):
    panel = panels.supplier_metrics(spark, folder)
    return forecast.forecast_custom_group(panel, _drift_line, "server_id string, timestamp date, predicted double", ["cpu_p95"])


_ERR = """avg(abs(actual - predicted)) AS mae, sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse"""
_SMAPE = "avg(CASE WHEN abs(actual) + abs(predicted) > 1e-8 THEN abs(actual - predicted) / (abs(actual) + abs(predicted)) ELSE 0.0 END) * 200 AS smape"
_SCORED = "(SELECT * FROM forecast WHERE actual IS NOT NULL AND predicted IS NOT NULL)"


@register("error_metrics", sql("forecast", f"""SELECT server_id, model, round(mae, 4) AS mae, round(rmse, 4) AS rmse, round(smape, 2) AS smape FROM (
    SELECT server_id, model, {_ERR}, {_SMAPE} FROM {_SCORED} GROUP BY 1, 2)"""))
def error_metrics(spark, folder):
    return evaluate.error_metrics(forecasts(spark, folder))


@register("smape_skip_zero", sql("forecast", f"""SELECT server_id, model, avg(2 * abs(actual - predicted) / nullif(abs(actual) + abs(predicted), 0)) * 100 AS smape, {_ERR} FROM {_SCORED} GROUP BY 1, 2"""), ["smape", "mae", "rmse"])
def smape_skip_zero(spark, folder):
    return evaluate.smape_skip_zero(forecasts(spark, folder))


@register("mape_eps", sql("forecast", f"SELECT server_id, model, {_ERR}, avg(abs(actual - predicted) / greatest(abs(actual), 2.220446049250313e-16::DOUBLE)) AS mape FROM {_SCORED} GROUP BY 1, 2"), ["mae", "rmse", "mape"])
def mape_eps(spark, folder):
    return evaluate.mape_eps(forecasts(spark, folder))


@register("mape_additive_eps", sql("forecast", f"SELECT server_id, model, avg(abs((actual - predicted) / nullif(actual + 1e-6::DOUBLE, 0))) * 100 AS mape FROM {_SCORED} GROUP BY 1, 2"), ["mape"])
def mape_additive_eps(spark, folder):
    return evaluate.mape_additive_eps(forecasts(spark, folder))


@register("compare_models", sql("forecast5", f"SELECT model, {_ERR}, {_SMAPE} FROM (SELECT * FROM forecast5 WHERE actual IS NOT NULL AND predicted IS NOT NULL) GROUP BY 1"), ["mae", "rmse", "smape"])
def compare_models(spark, folder):
    return evaluate.compare_models(forecasts(spark, folder, forecast.MODELS))


_MEANS = f"SELECT server_id, model, {_ERR}, {_SMAPE} FROM (SELECT * FROM forecast5 WHERE actual IS NOT NULL AND predicted IS NOT NULL) GROUP BY 1, 2"


@register("best_model", sql("forecast5", f"""SELECT arg_min(model, (s, model)) AS best_model, min(s) AS avg_smape, count(*) AS models FROM (SELECT model, avg(smape) AS s FROM ({_MEANS}) GROUP BY 1)"""), ["avg_smape"])
def best_model(spark, folder):
    return evaluate.best_model(evaluate.error_metrics(forecasts(spark, folder, forecast.MODELS), digits=False))


@register("improvement_over_baseline", sql("forecast5", f"""SELECT * FROM (WITH m AS (SELECT model, avg(mae) AS score FROM ({_MEANS}) GROUP BY 1)
    SELECT model, score, ((SELECT score FROM m WHERE model = 'baseline') - score) / (SELECT score FROM m WHERE model = 'baseline') * 100 AS improvement_pct FROM m)"""), ["score", "improvement_pct"])
def improvement_over_baseline(spark, folder):
    return evaluate.improvement_over_baseline(evaluate.error_metrics(forecasts(spark, folder, forecast.MODELS), digits=False))


@register("error_by_segment", sql("forecast types", f"""SELECT server_type, model, is_eoq_window, {_ERR}, {_SMAPE} FROM (SELECT f.*, server_type,
    CASE WHEN month(timestamp) IN (3, 6, 9, 12) AND day(timestamp) >= day(last_day(timestamp)) - 6 THEN 1 ELSE 0 END AS is_eoq_window FROM forecast f JOIN types USING (server_id) WHERE actual IS NOT NULL AND predicted IS NOT NULL)
    GROUP BY 1, 2, 3"""), ["mae", "rmse", "smape"])
def error_by_segment(spark, folder):
    from ..functions.calendar import eoq_window

    typed = joins.join_metadata(forecasts(spark, folder), joins.assign_by_share(panels.supplier_dimension(spark, folder)))
    return evaluate.error_metrics(typed.withColumn("is_eoq_window", eoq_window("timestamp")), ["server_type", "model", "is_eoq_window"], digits=False)


_CUTS = ("1997-01-01", "1998-01-01", "1999-01-01", "2000-01-01", "2001-01-01")
_FOLDS = " UNION ALL ".join(f"SELECT {i + 1} AS fold, DATE '{c}' AS cut" for i, c in enumerate(_CUTS))


@register("rolling_origin_eval", sql("cpu", f"""SELECT * FROM (WITH f AS ({_FOLDS}), t AS (SELECT server_id, fold, isodow(timestamp) AS d, avg(cpu_p95) AS m, count(*) AS n FROM cpu, f WHERE timestamp < cut GROUP BY 1, 2, 3),
    g AS (SELECT server_id, fold FROM t GROUP BY 1, 2 HAVING sum(n) >= 365)
    SELECT server_id, fold, {_ERR}, {_SMAPE} FROM (SELECT c.server_id, f.fold, c.cpu_p95 AS actual, t.m AS predicted FROM cpu c, f JOIN g ON g.server_id = c.server_id AND g.fold = f.fold
    JOIN t ON t.server_id = c.server_id AND t.fold = f.fold AND t.d = isodow(c.timestamp) WHERE c.timestamp >= f.cut AND c.timestamp < f.cut + 90) GROUP BY 1, 2)"""), ["mae", "rmse", "smape"])
def rolling_origin_eval(spark, folder):
    return evaluate.error_metrics(forecast.rolling_origin(cpu_panel(spark, folder), "cpu_p95", _CUTS), ["server_id", "fold"], digits=False)


@register("forecast_drift", sql("f_baseline f_additive", """SELECT coalesce(a.server_id, b.server_id) AS server_id, avg(abs(a.predicted - b.predicted)) AS mean_abs_change, count(*) FILTER (WHERE b.server_id IS NULL) AS only_new,
    count(*) FILTER (WHERE a.server_id IS NULL) AS only_old FROM f_additive a FULL JOIN (SELECT * FROM f_baseline WHERE is_future) b ON a.server_id = b.server_id AND a.timestamp = b.timestamp GROUP BY 1"""), ["mean_abs_change"])
def forecast_drift(spark, folder):
    new = forecasts(spark, folder, ("additive",))
    return evaluate.forecast_drift(new, forecasts(spark, folder, ("baseline",)).filter("is_future"))
