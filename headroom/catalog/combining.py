"""Joins, set operations, sorting and top rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import forecast, joins, risk
from ..sources import panels
from .base import CUT, METRICS, register, sql
from .shared import cpu_panel, forecasts, panel_coefficients


@register("join_metadata_left", sql("metrics dim", """SELECT m.*, region, criticality FROM metrics m LEFT JOIN (SELECT * FROM dim WHERE criticality <> 'Low') d USING (server_id)"""), METRICS)
def join_metadata_left(spark, folder):
    half = panels.supplier_dimension(spark, folder).filter("criticality <> 'Low'").select("server_id", "region", "criticality")
    return joins.join_metadata(panels.supplier_metrics(spark, folder), half)


@register("join_forecast_actual_inner", sql("forecast marked", """SELECT f.server_id, f.model, f.timestamp, f.predicted, m.y AS actual FROM forecast f
    JOIN marked m ON f.server_id = m.server_id AND f.timestamp = m.timestamp WHERE NOT m.train"""), ["predicted", "actual"])
def join_forecast_actual_inner(spark, folder):
    test = cpu_panel(spark, folder).filter(F.col("timestamp") >= F.lit(CUT).cast("date"))
    made = forecasts(spark, folder).select("server_id", "model", "timestamp", "predicted")
    return joins.join_forecast_actual(made, test, "cpu_p95").select("server_id", "model", "timestamp", "predicted", "actual")


@register("join_actual_left", sql("forecast marked", """SELECT f.server_id, f.model, f.timestamp, f.predicted, m.y AS actual FROM forecast f
    LEFT JOIN marked m ON f.server_id = m.server_id AND f.timestamp = m.timestamp"""), ["predicted", "actual"])
def join_actual_left(spark, folder):
    panel = cpu_panel(spark, folder)
    made = forecasts(spark, folder, panel=panel).select("server_id", "model", "timestamp", "predicted")
    # forecasts begin at the cut, so no day before it has a partner
    actual = panel.filter(F.col("timestamp") >= F.lit(CUT).cast("date"))
    return joins.join_forecast_actual(made, actual, "cpu_p95", "left").select("server_id", "model", "timestamp", "predicted", "actual")


@register("join_group_stat_back", sql("metrics", "SELECT server_id, timestamp, cpu_p95, max(mem_p95) OVER (PARTITION BY server_id) AS peak_mem FROM metrics"), ["cpu_p95", "peak_mem"])
def join_group_stat_back(spark, folder):
    from ..operators.segments import attach_entity_stats

    panel = panels.supplier_metrics(spark, folder)
    peaks = panel.groupBy("server_id").agg(F.max("mem_p95").alias("peak_mem"))
    return attach_entity_stats(panel.select("server_id", "timestamp", "cpu_p95"), peaks, ["server_id"], "timestamp")


@register("semi_join_membership", sql("metrics", """SELECT server_id, timestamp, server_id IN (SELECT server_id FROM metrics GROUP BY 1 HAVING avg(cpu_p95) > 55) AS is_busy FROM metrics"""))
def semi_join_membership(spark, folder):
    panel = panels.supplier_metrics(spark, folder)
    busy = panel.groupBy("server_id").agg(F.avg("cpu_p95").alias("m")).filter("m > 55")
    return joins.mark_members(panel.select("server_id", "timestamp"), busy, "is_busy")


@register("semi_join_filter", sql("metrics", "SELECT server_id, timestamp, cpu_p95 FROM metrics WHERE server_id IN (SELECT server_id FROM metrics GROUP BY 1 HAVING avg(cpu_p95) > 55)"), ["cpu_p95"])
def semi_join_filter(spark, folder):
    panel = panels.supplier_metrics(spark, folder).select("server_id", "timestamp", "cpu_p95")
    busy = panel.groupBy("server_id").agg(F.avg("cpu_p95").alias("m")).filter("m > 55")
    return panel.join(busy, "server_id", "left_semi")


@register("lookup_map", sql("metrics types", """SELECT m.server_id, m.timestamp, server_type, w.weekday_mean FROM metrics m LEFT JOIN types USING (server_id)
    LEFT JOIN (SELECT isodow(timestamp) AS d, avg(cpu_p95) AS weekday_mean FROM metrics GROUP BY 1) w ON isodow(m.timestamp) = w.d"""), ["weekday_mean"])
def lookup_map(spark, folder):
    panel = panels.supplier_metrics(spark, folder).select("server_id", "timestamp", "cpu_p95")
    days = panel.groupBy(F.weekday("timestamp").alias("_d")).agg(F.avg("cpu_p95").alias("weekday_mean"))
    typed = joins.join_metadata(panel, joins.assign_by_share(panels.supplier_dimension(spark, folder)))
    # one row per weekday: seven rows at most
    return typed.withColumn("_d", F.weekday("timestamp")).join(F.broadcast(days), "_d", "left").select("server_id", "timestamp", "server_type", "weekday_mean")


@register("assign_by_share", sql("types", "SELECT * FROM types"))
def assign_by_share(spark, folder):
    return joins.assign_by_share(panels.supplier_dimension(spark, folder))


@register("union_all", sql("f_baseline f_naive", "SELECT server_id, model, timestamp, predicted FROM f_baseline UNION ALL SELECT server_id, model, timestamp, predicted FROM f_naive"), ["predicted"])
def union_all(spark, folder):
    panel = cpu_panel(spark, folder)
    coef = panel_coefficients(panel)
    one = forecasts(spark, folder, ("baseline",), panel, coef).select("server_id", "model", "timestamp", "predicted")
    two = forecasts(spark, folder, ("naive",), panel, coef).select("server_id", "model", "timestamp", "predicted")
    return one.unionAll(two)


@register("union_by_name_fill", sql("f_baseline f_naive", """SELECT server_id, timestamp, model, predicted, actual, NULL::BOOLEAN AS is_future FROM f_naive
    UNION ALL SELECT server_id, timestamp, model, predicted, NULL, is_future FROM f_baseline"""), ["predicted", "actual"])
def union_by_name_fill(spark, folder):
    panel = cpu_panel(spark, folder)
    coef = panel_coefficients(panel)
    one = forecasts(spark, folder, ("baseline",), panel, coef).select("server_id", "model", "timestamp", "predicted", "is_future")
    two = forecasts(spark, folder, ("naive",), panel, coef).select("server_id", "timestamp", "model", "predicted", "actual")
    return one.unionByName(two, allowMissingColumns=True)


@register("union_distinct_sorted", sql("metrics", f"""SELECT DISTINCT timestamp FROM (SELECT timestamp FROM metrics WHERE timestamp < DATE '{CUT}' UNION ALL SELECT timestamp FROM metrics WHERE timestamp >= DATE '{CUT}'
    UNION ALL SELECT CAST(unnest(generate_series(CAST(e AS TIMESTAMP) + INTERVAL 1 DAY, CAST(e AS TIMESTAMP) + INTERVAL 90 DAY, INTERVAL 1 DAY)) AS DATE) FROM (SELECT max(timestamp) AS e FROM metrics GROUP BY server_id)) ORDER BY 1"""))
def union_distinct_sorted(spark, folder):
    days = panels.supplier_readings(spark, folder).select("server_id", "timestamp")
    marked = forecast.split_label(days, CUT)
    return joins.distinct_sorted([marked.filter("split = 'train'"), marked.filter("split = 'test'"), forecast.future_days(days)], "timestamp")


@register("union_history_forecast", sql("cpu f_baseline", """SELECT server_id, timestamp, cpu_p95, 'history' AS source FROM cpu UNION ALL SELECT server_id, timestamp, predicted, 'forecast' FROM f_baseline WHERE is_future"""), ["cpu_p95"])
def union_history_forecast(spark, folder):
    past = cpu_panel(spark, folder).withColumn("source", F.lit("history"))
    ahead = forecasts(spark, folder, ("baseline",)).filter("is_future").select("server_id", "timestamp", F.col("predicted").alias("cpu_p95"), F.lit("forecast").alias("source"))
    return past.unionByName(ahead)


@register("sort_panel", sql("metrics", "SELECT server_id, timestamp, cpu_p95 FROM metrics ORDER BY 1, 2"), ["cpu_p95"])
def sort_panel(spark, folder):
    return panels.supplier_metrics(spark, folder).select("server_id", "timestamp", "cpu_p95").orderBy("server_id", "timestamp")


@register("head_n", sql("metrics", "SELECT server_id, timestamp, cpu_p95 FROM metrics ORDER BY 1, 2 LIMIT 200"), ["cpu_p95"])
def head_n(spark, folder):
    return panels.supplier_metrics(spark, folder).select("server_id", "timestamp", "cpu_p95").orderBy("server_id", "timestamp").limit(200)


@register("top_risky_servers", sql("f_baseline", """SELECT server_id, max(predicted) AS max_predicted, avg(predicted) AS mean_predicted, count(*) FILTER (WHERE predicted > 53) AS breach_days
    FROM f_baseline GROUP BY 1 HAVING count(*) FILTER (WHERE predicted > 53) > 0 ORDER BY max_predicted DESC, server_id LIMIT 10"""), ["max_predicted", "mean_predicted"])
def top_risky_servers(spark, folder):
    return risk.breach_report(forecasts(spark, folder, ("baseline",)), 53.0).limit(10)
