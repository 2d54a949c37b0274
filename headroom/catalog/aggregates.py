"""Grouped reports and chart tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.sizing import stored
from ..operators import joins, report, risk
from ..sources import panels
from .base import CUT, METRICS, register, sql
from .shared import forecasts


@register("mean_by_group", sql("panel", "SELECT business_unit, criticality, avg(cpu_p95) AS mean_cpu_p95, count(*) AS rows FROM panel GROUP BY 1, 2"), ["mean_cpu_p95"])
def mean_by_group(spark, folder):
    return report.mean_by_group(panels.supplier_panel(spark, folder), ["business_unit", "criticality"], "cpu_p95")


@register("fleet_mean_by_time", sql("metrics", "SELECT timestamp, avg(cpu_p95) AS cpu_p95, avg(mem_p95) AS mem_p95 FROM metrics GROUP BY 1"), ["cpu_p95", "mem_p95"])
def fleet_mean_by_time(spark, folder):
    return panels.supplier_metrics(spark, folder).groupBy("timestamp").agg(F.avg("cpu_p95").alias("cpu_p95"), F.avg("mem_p95").alias("mem_p95"))


@register("monthly_profile", sql("metrics", """SELECT server_id, month, mean_value, avg(mean_value) OVER (PARTITION BY server_id) AS mean_of_months FROM (
    SELECT server_id, month(timestamp) AS month, avg(cpu_p95) AS mean_value FROM metrics GROUP BY 1, 2)"""), ["mean_value", "mean_of_months"])
def monthly_profile(spark, folder):
    return report.monthly_profile(panels.supplier_metrics(spark, folder), "cpu_p95")


@register("weekly_profile", sql("metrics types", """SELECT isodow(timestamp) - 1 AS weekday, avg(cpu_p95) AS mean_value FROM metrics JOIN types USING (server_id) WHERE server_type = 'web' GROUP BY 1"""), ["mean_value"])
def weekly_profile(spark, folder):
    web = joins.assign_by_share(panels.supplier_dimension(spark, folder)).filter("server_type = 'web'")
    return report.weekly_profile(panels.supplier_metrics(spark, folder).join(web, "server_id", "left_semi"), "cpu_p95")


@register("servers_per_group", sql("panel", """SELECT business_unit, servers, servers * 100.0::DOUBLE / sum(servers) OVER () AS share_pct FROM (
    SELECT business_unit, count(DISTINCT server_id) AS servers FROM panel GROUP BY 1)"""), ["share_pct"])
def servers_per_group(spark, folder):
    return report.servers_per_group(panels.supplier_panel(spark, folder), ["business_unit"])


@register("multi_agg_flat", sql("metrics", """SELECT server_id, avg(cpu_p95) AS cpu_p95_mean, stddev_samp(cpu_p95) AS cpu_p95_std, max(cpu_p95) AS cpu_p95_max, sum(net_out_p95) AS net_out_p95_sum FROM metrics GROUP BY 1"""),
    ["cpu_p95_mean", "cpu_p95_std", "cpu_p95_max", "net_out_p95_sum"])
def multi_agg_flat(spark, folder):
    return report.multi_agg(panels.supplier_metrics(spark, folder), ["server_id"], {"cpu_p95": ["mean", "std", "max"], "net_out_p95": ["sum"]})


@register("conditional_count", sql("metrics", "SELECT server_id, count(*) FILTER (WHERE cpu_p95 > 80) AS breach_rows, count(*) AS rows FROM metrics GROUP BY 1"))
def conditional_count(spark, folder):
    return panels.supplier_metrics(spark, folder).groupBy("server_id").agg(F.count_if(F.col("cpu_p95") > 80).alias("breach_rows"), F.count(F.lit(1)).alias("rows"))


@register("global_quantile", sql("metrics", "SELECT quantile_cont(mem_p95, 0.95) AS p95 FROM metrics"), ["p95"])
def global_quantile(spark, folder):
    from ..operators.quantiles import exact_quantiles

    return exact_quantiles(panels.supplier_metrics(spark, folder), [], "mem_p95", [0.95]).select(F.col("quantile").alias("p95"))


@register("arg_min_max", sql("metrics", """SELECT arg_min(server_id, (v, server_id)) AS min_key, min(v) AS min_value, arg_min(server_id, (-v, server_id)) AS max_key, max(v) AS max_value
    FROM (SELECT server_id, avg(cpu_p95) AS v FROM metrics GROUP BY 1)"""), ["min_value", "max_value"])
def arg_min_max(spark, folder):
    means = panels.supplier_metrics(spark, folder).groupBy("server_id").agg(F.avg("cpu_p95").alias("v"))
    return report.extremes(means, "server_id", "v")


@register("sql_avg_predicted", sql("forecast", "SELECT server_id, AVG(predicted) AS avg_predicted FROM forecast WHERE is_future GROUP BY server_id"), ["avg_predicted"])
def sql_avg_predicted(spark, folder):
    return spark.sql("SELECT server_id, AVG(predicted) AS avg_predicted FROM {f} WHERE is_future GROUP BY server_id", f=forecasts(spark, folder))


@register("forecast_vs_actual", sql("f_baseline", f"""SELECT timestamp, actual, predicted FROM f_baseline WHERE server_id = (SELECT min(server_id) FROM f_baseline) AND timestamp >= DATE '{CUT}'"""), ["actual", "predicted"])
def forecast_vs_actual(spark, folder):
    first = panels.supplier_readings(spark, folder).agg(F.min("server_id")).scalar()
    return forecasts(spark, folder, ("baseline",)).filter((F.col("server_id") == first) & (F.col("timestamp") >= F.lit(CUT).cast("date"))).select("timestamp", "actual", "predicted")


@register("box_stats", sql("metrics", " UNION ALL ".join(f"""SELECT '{m}' AS metric, min({m}) AS min, quantile_cont({m}, 0.25) AS q1, median({m}) AS median, quantile_cont({m}, 0.75) AS q3, max({m}) AS max FROM metrics"""
    for m in METRICS)), ["min", "q1", "median", "q3", "max"])
def box_stats(spark, folder):
    return report.box_stats(panels.supplier_metrics(spark, folder), METRICS)


@register("density_histogram", sql("metrics", " UNION ALL ".join(f"""SELECT '{m}' AS metric, CASE WHEN {m} >= 100 THEN 21 ELSE CAST(floor({m} / 5.0) AS BIGINT) + 1 END AS bin, count(*) AS rows FROM metrics GROUP BY 2"""
    for m in METRICS)))
def density_histogram(spark, folder):
    return report.histogram(panels.supplier_metrics(spark, folder), METRICS)


@register("profile_catalogue", sql("types", """SELECT server_type, count(*) AS servers, CASE server_type WHEN 'web' THEN 45.0 WHEN 'database' THEN 35.0 WHEN 'application' THEN 50.0 ELSE 30.0 END::DOUBLE AS base_cpu,
    CASE server_type WHEN 'web' THEN 0.03 WHEN 'database' THEN 0.01 WHEN 'application' THEN 0.02 ELSE 0.08 END::DOUBLE AS spike_probability FROM types GROUP BY 1"""), ["base_cpu", "spike_probability"])
def profile_catalogue(spark, folder):
    fleet = joins.assign_by_share(panels.supplier_dimension(spark, folder)).groupBy("server_type").agg(F.count(F.lit(1)).alias("servers"))
    return fleet.join(report.profile_catalogue(spark), "server_type").select("server_type", "servers", "base_cpu", "spike_probability")


def _codes(spark, folder):
    return risk.risk_code_table(risk.risk_flags(forecasts(spark, folder), 53.0))


_CODES = sql("flagged", """SELECT server_id, timestamp, arg_min(CASE risk_level WHEN 'high' THEN 2 WHEN 'medium' THEN 1 ELSE 0 END, model) AS risk_code FROM flagged GROUP BY 1, 2""")


@register("risk_codes", _CODES)
def risk_codes(spark, folder):
    """The cells of the heat map that have a value, in long form."""
    return _codes(spark, folder)


def _matrix_sql(cell: str) -> str:
    return sql("flagged", f"""SELECT server_id, DATE '1970-01-01' + CAST({risk.BLOCK_DAYS} * block AS INTEGER) AS block_start, count(*) AS n_days,
    string_agg({cell}, ',' ORDER BY timestamp) AS codes
    FROM (SELECT DISTINCT server_id FROM flagged) CROSS JOIN (SELECT DISTINCT timestamp, floor(datediff('day', DATE '1970-01-01', timestamp) / {risk.BLOCK_DAYS}.0) AS block FROM flagged)
    LEFT JOIN (SELECT server_id, timestamp, arg_min(CASE risk_level WHEN 'high' THEN 2 WHEN 'medium' THEN 1 ELSE 0 END, model) AS code FROM flagged GROUP BY 1, 2)
    USING (server_id, timestamp) GROUP BY server_id, block""")


def _matrix_text(matrix):
    """A row for each server and block: its values in order of the days, nothing where there is none."""
    text = F.array_join(F.transform("values", lambda v: F.coalesce(v.cast("string"), F.lit(""))), ",")
    start = F.date_from_unix_date(F.col("block") * F.lit(risk.BLOCK_DAYS))
    return matrix.select("server_id", start.alias("block_start"), F.size("days").cast("long").alias("n_days"), text.alias("codes"))


@register("pivot_first", _matrix_sql("coalesce(CAST(code AS VARCHAR), '')"))
def pivot_first(spark, folder):
    """The server x day matrix over all days, in blocks; cells without a row stay empty."""
    return _matrix_text(risk.matrix_blocks(stored(risk.sparse_blocks(_codes(spark, folder)), "blocks")))


@register("risk_heatmap_table", _matrix_sql("CAST(coalesce(code, 0) AS VARCHAR)"))
def risk_heatmap_table(spark, folder):
    """The heat map over all days, in blocks; cells without a row are 0."""
    return _matrix_text(risk.matrix_blocks(stored(risk.sparse_blocks(_codes(spark, folder)), "blocks"), 0))


@register("risk_heatmap_days", sql("flagged", """SELECT server_id, timestamp, coalesce(arg_min(CASE risk_level WHEN 'high' THEN 2 WHEN 'medium' THEN 1 ELSE 0 END, model) FILTER (WHERE model IS NOT NULL), 0) AS risk_code
    FROM (SELECT DISTINCT server_id FROM flagged) CROSS JOIN (SELECT DISTINCT timestamp FROM flagged) LEFT JOIN flagged USING (server_id, timestamp) GROUP BY 1, 2"""))
def risk_heatmap_days(spark, folder):
    """The heat map over all days of the panel's forecasts, in long form."""
    return risk.matrix_days(risk.matrix_blocks(stored(risk.sparse_blocks(_codes(spark, folder)), "blocks"), 0))


@register("risk_by_dimension", sql("f_baseline dim", """SELECT region, server_id, count(*) OVER (PARTITION BY region) AS risky_servers FROM (SELECT DISTINCT server_id FROM f_baseline WHERE predicted > 53) JOIN dim USING (server_id)"""))
def risk_by_dimension(spark, folder):
    risky = forecasts(spark, folder, ("baseline",)).filter("predicted > 53")
    return report.risk_by_dimension(risky, panels.supplier_dimension(spark, folder), "region")


@register("hot_last_n_days", sql("metrics", """SELECT server_id, max(cpu_p95) AS max_value, count(*) AS hot_days FROM metrics WHERE timestamp > (SELECT max(timestamp) FROM metrics) - 30 AND cpu_p95 > 80 GROUP BY 1"""), ["max_value"])
def hot_last_n_days(spark, folder):
    return report.hot_last_days(panels.supplier_metrics(spark, folder), "cpu_p95", 80.0)


@register("avg_next_n_days_by_unit", sql("f_baseline dim", """SELECT business_unit, avg(predicted) AS mean_predicted, count(DISTINCT server_id) AS servers FROM f_baseline JOIN dim USING (server_id) WHERE is_future GROUP BY 1"""), ["mean_predicted"])
def avg_next_n_days_by_unit(spark, folder):
    return report.next_days_by_group(forecasts(spark, folder, ("baseline",)), panels.supplier_dimension(spark, folder), "business_unit")

