"""Sources and sinks. What is written here is read back, so the rows compared are the files' rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.sizing import scratch
from ..operators import regularise, validate
from ..sources import files as S
from ..sources import panels
from .base import METRICS, register, sql

_PANEL_SCHEMA = (
    "server_id string, timestamp date, business_unit string, region string, criticality string, "
    "cpu_p95 double, mem_p95 double, disk_p95 double, net_in_p95 double, net_out_p95 double"
)


@register("scan_parquet", "SELECT * FROM lineitem")
def scan_parquet(spark, folder):
    return S.read_panel(spark, f"{folder}/lineitem.parquet", "parquet")


@register("scan_csv", sql("panel", "SELECT * FROM panel"), METRICS)
def scan_csv(spark, folder):
    path = scratch(spark, "csv")
    S.write_csv(panels.supplier_panel(spark, folder), path, compress=True)
    return S.read_panel(spark, path, "csv", _PANEL_SCHEMA, parts=8)


@register("scan_json_record")
def scan_json_record(spark, folder):
    path = scratch(spark, "json")
    S.write_summary(_summary(spark, folder), path)
    return S.read_panel(spark, path, "json")


@register("scan_object_store", "SELECT count(*) AS rows, min(l_shipdate) AS first_ship FROM lineitem")
def scan_object_store(spark, folder):
    bucket, key = folder.strip("/").split("/", 1)
    lines = S.read_object(spark, f"/{bucket}", f"{key}/lineitem.parquet", "parquet", scheme="file")
    return lines.agg(F.count(F.lit(1)).alias("rows"), F.min("l_shipdate").alias("first_ship"))


@register("latest_snapshot", sql("metrics", "SELECT * FROM metrics"), METRICS)
def latest_snapshot(spark, folder):
    root = scratch(spark, "snapshots")
    panel = panels.supplier_metrics(spark, folder)
    S.write_parquet(panel.filter(F.col("timestamp") < "2000-01-01"), f"{root}/v1.parquet")
    S.write_parquet(panel, f"{root}/v2.parquet")
    return S.latest_snapshot(spark, root, "v*.parquet")


@register("sink_parquet", sql("panel", "SELECT * FROM panel"), METRICS)
def sink_parquet(spark, folder):
    path = scratch(spark, "parquet")
    S.write_parquet(panels.supplier_panel(spark, folder), path)
    return spark.read.parquet(path)


@register("sink_csv", sql("panel", "SELECT * FROM panel"), METRICS)
def sink_csv(spark, folder):
    path = scratch(spark, "csv")
    S.write_csv(panels.supplier_panel(spark, folder), path)
    return S.read_panel(spark, path, "csv", _PANEL_SCHEMA)


@register("sink_partitioned", sql("metrics", "SELECT * FROM metrics WHERE timestamp BETWEEN DATE '1998-03-20' AND DATE '1998-04-10'"), METRICS)
def sink_partitioned(spark, folder):
    path = scratch(spark, "lake")
    S.write_partitioned(panels.supplier_metrics(spark, folder), path)
    return S.read_partitioned(spark, path, "1998-03-20", "1998-04-10")


def _summary(spark, folder):
    from ..operators import clean

    removed = clean.duplicates_removed(panels.supplier_readings(spark, folder)).select("duplicates_removed").scalar()
    return validate.load_summary(panels.supplier_spine(spark, folder), METRICS, removed)


@register("sink_summary_json")
def sink_summary_json(spark, folder):
    path = scratch(spark, "summary")
    S.write_summary(_summary(spark, folder), path)
    return spark.read.json(path)


@register("sink_sample_rows", sql("panel", "SELECT * FROM panel ORDER BY server_id, timestamp LIMIT 200"), METRICS)
def sink_sample_rows(spark, folder):
    path = scratch(spark, "sample")
    S.write_csv(S.sample_rows(panels.supplier_panel(spark, folder), ["server_id", "timestamp"]), path)
    return S.read_panel(spark, path, "csv", _PANEL_SCHEMA)


@register("date_stamped_name", sql("readings", """SELECT 'raw_server_metrics_' || strftime(min(timestamp), '%Y%m%d') || '_to_'
    || strftime(max(timestamp), '%Y%m%d') || '.parquet' AS file_name FROM readings"""))
def date_stamped_name(spark, folder):
    return S.date_stamped_name(panels.supplier_readings(spark, folder))


@register("export_target_series", sql("metrics", """SELECT server_id AS item_id, strftime(timestamp, '%Y-%m-%d') AS timestamp,
    cpu_p95 AS target_value FROM metrics"""), ["target_value"])
def export_target_series(spark, folder):
    path = scratch(spark, "series")
    S.write_csv(S.target_series(panels.supplier_metrics(spark, folder), "cpu_p95"), path, header=False)
    return spark.read.schema("item_id string, timestamp string, target_value double").csv(path)


@register("resample_daily", sql("events_", """SELECT a.server_id, a.timestamp, cpu_p95 FROM (
    SELECT server_id, CAST(unnest(generate_series(date_trunc('day', min(timestamp)), date_trunc('day', max(timestamp)), INTERVAL 1 DAY)) AS DATE) AS timestamp
    FROM events_ GROUP BY server_id) a LEFT JOIN (SELECT server_id, CAST(timestamp AS DATE) AS timestamp, max(cpu_p95) AS cpu_p95 FROM events_ GROUP BY 1, 2) d
    ON a.server_id = d.server_id AND a.timestamp = d.timestamp"""), ["cpu_p95"])
def resample_daily(spark, folder):
    return regularise.resample_daily(panels.event_readings(spark, folder), ["cpu_p95"])


@register("date_spine", sql("metrics", """SELECT CAST(unnest(generate_series(CAST(min(timestamp) AS TIMESTAMP), CAST(max(timestamp) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS timestamp
    FROM metrics"""))
def date_spine(spark, folder):
    from ..functions.calendar import date_axis

    span = panels.supplier_metrics(spark, folder).agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"))
    return date_axis(spark, span.select("lo").scalar(), span.select("hi").scalar())


@register("date_spine_hourly", sql("events_", """SELECT unnest(generate_series(date_trunc('hour', min(timestamp)), date_trunc('hour', max(timestamp)), INTERVAL 1 HOUR)) AS timestamp
    FROM events_"""))
def date_spine_hourly(spark, folder):
    from ..functions.calendar import date_axis

    hour = F.date_trunc("hour", F.col("timestamp")).cast("timestamp_ntz")
    span = panels.event_readings(spark, folder).agg(F.min(hour).alias("lo"), F.max(hour).alias("hi"))
    return date_axis(spark, span.select("lo").scalar(), span.select("hi").scalar(), "1 hour")


@register("p95_rollup", sql("events_", "SELECT server_id, CAST(timestamp AS DATE) AS timestamp, quantile_cont(cpu_p95, 0.95) AS cpu_p95 FROM events_ GROUP BY 1, 2"), ["cpu_p95"])
def p95_rollup(spark, folder):
    return regularise.percentile_rollup(panels.event_readings(spark, folder), ["cpu_p95"])


@register("panel_spine_cross", sql("metrics", """SELECT server_id, timestamp FROM (SELECT DISTINCT server_id FROM metrics), (
    SELECT CAST(unnest(generate_series(CAST(min(timestamp) AS TIMESTAMP), CAST(max(timestamp) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS timestamp FROM metrics)"""))
def panel_spine_cross(spark, folder):
    return regularise.fleet_spine(panels.supplier_readings(spark, folder).select("server_id", "timestamp"))
