"""Risk flags, under-use, clusters, savings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import forecast, risk
from ..sources import panels
from .base import CUT, METRICS, holiday_sql, register, sql
from .shared import cpu_panel, forecasts

# the fixture's forecasts lie between 47 and 58, so its limits are set inside that range
HOT, COLD = 53.0, 51.0


@register("risk_flags", sql("flagged", "SELECT server_id, model, timestamp, predicted, risk_flag, risk_level FROM flagged"), ["predicted"])
def risk_flags(spark, folder):
    return risk.risk_flags(forecasts(spark, folder).select("server_id", "model", "timestamp", "predicted"), HOT)


@register("risk_flags_actual", sql("cpu", """SELECT server_id, timestamp, coalesce(cpu_p95 > 80, false) AS risk_flag, CASE WHEN cpu_p95 > 80 * 1.2::DOUBLE THEN 'high' WHEN cpu_p95 > 80 THEN 'medium' ELSE 'low' END AS risk_level FROM cpu"""))
def risk_flags_actual(spark, folder):
    return risk.risk_flags(cpu_panel(spark, folder), value="cpu_p95").drop("cpu_p95")


_LIMITS = {"cpu_p95": 90.0, "mem_p95": 85.0, "disk_p95": 95.0}


@register("risk_flags_multi", sql("spine", "SELECT server_id, timestamp, " + ", ".join(f"coalesce({m} > {t}, false) AS {m}_risk" for m, t in _LIMITS.items()) + ", "
    + " OR ".join(f"coalesce({m} > {t}, false)" for m, t in _LIMITS.items()) + " AS any_risk FROM spine"))
def risk_flags_multi(spark, folder):
    return risk.risk_flags_multi(panels.supplier_spine(spark, folder), _LIMITS).drop(*METRICS)


_SEASON = f"""SELECT *, month(timestamp) AS month, month(timestamp) % 3 = 0 AND timestamp = last_day(timestamp) AS is_eoq, {holiday_sql('timestamp')} AS is_holiday FROM forecast"""


@register("seasonal_peak", sql("forecast", f"""SELECT server_id, model, timestamp, month, is_eoq, is_holiday, p AS seasonal_peak_risk, p / 53.0::DOUBLE * 100 AS seasonal_peak_pct FROM (
    SELECT *, max(CASE WHEN is_future AND (is_eoq OR is_holiday = 1) THEN predicted END) OVER (PARTITION BY server_id) AS p FROM ({_SEASON}))"""), ["seasonal_peak_risk", "seasonal_peak_pct"])
def seasonal_peak(spark, folder):
    out = risk.seasonal_peak(forecasts(spark, folder).select("server_id", "model", "timestamp", "predicted", "is_future"), threshold=HOT)
    return out.drop("predicted", "is_future")


@register("underutilized", sql("forecast", """SELECT server_id, model, timestamp, coalesce(avg(predicted) FILTER (WHERE is_future) OVER (PARTITION BY server_id) < 51, false) AS is_underutilized FROM forecast"""))
def underutilized(spark, folder):
    return risk.underutilized(forecasts(spark, folder), COLD).select("server_id", "model", "timestamp", "is_underutilized")


def _clusters(spark, folder):
    profile = risk.usage_profile(forecasts(spark, folder))
    return risk.cluster_servers(profile, ["predicted_mean", "predicted_std"])


@register("cluster_servers")
def cluster_servers(spark, folder):
    return _clusters(spark, folder)


@register("consolidation_savings")
def consolidation_savings(spark, folder):
    return risk.consolidation_savings(_clusters(spark, folder))


@register("cluster_summary")
def cluster_summary(spark, folder):
    return risk.cluster_summary(_clusters(spark, folder))


@register("risk_summary", sql("forecast", """SELECT count(DISTINCT server_id) AS total_servers, count(*) FILTER (WHERE r) AS flagged_rows, count(DISTINCT server_id) FILTER (WHERE r) AS flagged_servers,
    count(*) FILTER (WHERE u) AS underutilized_rows, count(DISTINCT server_id) FILTER (WHERE u) AS underutilized_servers FROM (
    SELECT server_id, coalesce(predicted > 53, false) AS r, coalesce(avg(predicted) FILTER (WHERE is_future) OVER (PARTITION BY server_id) < 51, false) AS u FROM forecast)"""))
def risk_summary(spark, folder):
    return risk.risk_summary(risk.underutilized(risk.risk_flags(forecasts(spark, folder), HOT), COLD))


@register("breach_report", sql("f_baseline", f"""SELECT server_id, max(predicted) AS max_predicted, avg(predicted) AS mean_predicted, count(*) FILTER (WHERE predicted > 53) AS breach_days FROM f_baseline
    WHERE timestamp >= DATE '{CUT}' GROUP BY 1 HAVING count(*) FILTER (WHERE predicted > 53) > 0"""), ["max_predicted", "mean_predicted"])
def breach_report(spark, folder):
    return risk.breach_report(forecasts(spark, folder, ("baseline",)), HOT, CUT)


@register("flag_history_and_forecast", sql("cpu f_baseline", """SELECT server_id, timestamp, cpu_p95, is_future, 1 AS risk_flag FROM (SELECT server_id, timestamp, cpu_p95, false AS is_future FROM cpu
    UNION ALL SELECT server_id, timestamp, predicted, true FROM f_baseline WHERE is_future) WHERE cpu_p95 > 53"""), ["cpu_p95"])
def flag_history_and_forecast(spark, folder):
    ahead = forecasts(spark, folder, ("baseline",)).filter("is_future")
    return risk.flag_history_and_forecast(cpu_panel(spark, folder), ahead, "cpu_p95", HOT)


@register("risk_category", sql("f_baseline", """SELECT server_id, max(predicted) AS max_predicted, avg(predicted) AS mean_predicted, CASE WHEN max(predicted) > 54 THEN 'very_high' WHEN max(predicted) > 53 THEN 'high'
    WHEN avg(predicted) < 51 THEN 'underutilized' ELSE 'normal' END AS risk_category FROM f_baseline WHERE is_future GROUP BY 1"""), ["max_predicted", "mean_predicted"])
def risk_category(spark, folder):
    return risk.risk_category(forecasts(spark, folder, ("baseline",)), 54.0, HOT, COLD)


@register("risk_on_upper_quantile", sql("target wdmean train", """SELECT t.server_id, t.timestamp, m + q AS p90, CASE WHEN m + q > 90 THEN 'high' ELSE 'normal' END AS risk_level FROM target t JOIN wdmean w ON t.server_id = w.server_id AND t.wd = w.wd
    JOIN (SELECT t.server_id, quantile_cont(y - m, 0.9) AS q FROM train t JOIN wdmean w ON t.server_id = w.server_id AND t.wd = w.wd GROUP BY 1) q ON t.server_id = q.server_id WHERE t.is_future"""), ["p90"])
def risk_on_upper_quantile(spark, folder):
    made = forecast.forecast_quantiles(cpu_panel(spark, folder), "cpu_p95", CUT, probs=(0.9,))
    return made.withColumn("risk_level", F.when(F.col("p90") > 90, "high").otherwise("normal"))
