"""Projections, predicates and calendar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions import numeric as N
from ..operators import joins, report
from ..sources import panels
from .base import METRICS, eoq_sql, holiday_sql, quarter_end_sql, register, sql

T = "timestamp"


def _days(spark, folder):
    return panels.supplier_readings(spark, folder).select("server_id", "timestamp").distinct()


def _days_sql(select: str) -> str:
    return sql("readings", f"SELECT server_id, timestamp, {select} FROM (SELECT DISTINCT server_id, timestamp FROM readings)")


@register("parse_timestamp", "SELECT event_id, ts AS timestamp FROM events")
def parse_timestamp(spark, folder):
    text = panels.table(spark, folder, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("text"))
    return text.select("event_id", F.to_timestamp_ntz("text").alias("timestamp"))


@register("coerce_timestamp", """SELECT count(*) AS rows, count(CASE WHEN event_type IN ('click', 'view') THEN ts END) AS parsed,
    count(CASE WHEN event_type NOT IN ('click', 'view') THEN 1 END) AS unparseable FROM events""")
def coerce_timestamp(spark, folder):
    dirty = F.when(F.col("event_type").isin("click", "view"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(F.col("event_type"))
    rows = panels.table(spark, folder, "events").select(dirty.alias("text")).withColumn("t", F.try_to_timestamp("text", F.lit("yyyy-MM-dd HH:mm:ss")))
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.count("t").alias("parsed"), F.count_if(F.col("t").isNull() & F.col("text").isNotNull()).alias("unparseable"))


@register("canonical_columns", sql("metrics", "SELECT server_id AS item_id, timestamp AS ds, cpu_p95 AS y FROM metrics"), ["y"])
def canonical_columns(spark, folder):
    return panels.supplier_metrics(spark, folder).select("server_id", "timestamp", "cpu_p95").withColumnsRenamed(
        {"server_id": "item_id", "timestamp": "ds", "cpu_p95": "y"})


@register("calendar_parts", _days_sql("""year(timestamp) AS year, month(timestamp) AS month, quarter(timestamp) AS quarter, isodow(timestamp) - 1 AS dayofweek,
    dayofyear(timestamp) AS dayofyear, CASE WHEN isodow(timestamp) >= 6 THEN 1 ELSE 0 END AS is_weekend"""))
def calendar_parts(spark, folder):
    return _days(spark, folder).withColumns(C.calendar_parts(T))


@register("calendar_features", _days_sql(f"""year(timestamp) AS year, month(timestamp) AS month, quarter(timestamp) AS quarter, isodow(timestamp) - 1 AS dayofweek,
    CASE WHEN isodow(timestamp) >= 6 THEN 1 ELSE 0 END AS is_weekend, {quarter_end_sql(T)} AS is_eoq, {holiday_sql(T)} AS is_holiday"""))
def calendar_features(spark, folder):
    return C.calendar_features(_days(spark, folder))


@register("is_quarter_end", _days_sql(f"{quarter_end_sql(T)} AS is_quarter_end"))
def is_quarter_end(spark, folder):
    return _days(spark, folder).withColumn("is_quarter_end", C.is_quarter_end(T))


@register("eoq_window", _days_sql(f"{eoq_sql(T)} AS is_eoq_window"))
def eoq_window(spark, folder):
    return _days(spark, folder).withColumn("is_eoq_window", C.eoq_window(T))


@register("eoq_window_fixed31", _days_sql(f"{eoq_sql(T, 'fixed31')} AS is_eoq_window"))
def eoq_window_fixed31(spark, folder):
    return _days(spark, folder).withColumn("is_eoq_window", C.eoq_window(T, variant="fixed31"))


@register("holiday_flag", _days_sql(f"{holiday_sql(T)} AS is_holiday"))
def holiday_flag(spark, folder):
    return _days(spark, folder).withColumn("is_holiday", C.is_holiday(T))


@register("cyclic_month", _days_sql("sin(2 * pi() * month(timestamp) / 12) AS month_sin, cos(2 * pi() * month(timestamp) / 12) AS month_cos"), ["month_sin", "month_cos"])
def cyclic_month(spark, folder):
    sin, cos = C.cyclic_month(T)
    return _days(spark, folder).withColumns({"month_sin": sin, "month_cos": cos})


@register("future_calendar", sql("metrics", f"""SELECT server_id, timestamp, {quarter_end_sql(T)} AS is_eoq_window, 0 AS is_holiday, CASE WHEN isodow(timestamp) >= 6 THEN 1 ELSE 0 END AS is_weekend,
    quarter(timestamp) AS quarter, month(timestamp) AS month, sin(2 * pi() * month(timestamp) / 12) AS month_sin, cos(2 * pi() * month(timestamp) / 12) AS month_cos FROM (
    SELECT server_id, CAST(unnest(generate_series(CAST(max(timestamp) AS TIMESTAMP) + INTERVAL 1 DAY, CAST(max(timestamp) AS TIMESTAMP) + INTERVAL 90 DAY, INTERVAL 1 DAY)) AS DATE) AS timestamp
    FROM metrics GROUP BY server_id)"""), ["month_sin", "month_cos"])
def future_calendar(spark, folder):
    from ..operators.forecast import future_days

    ahead = future_days(panels.supplier_readings(spark, folder))
    return ahead.withColumns(C.future_regressors(T, "zero", "quarter_end"))


@register("days_since_start", _days_sql("datediff('day', (SELECT min(timestamp) FROM readings), timestamp) AS days_since_start"))
def days_since_start(spark, folder):
    from ..operators.features import days_since_start as since

    return since(_days(spark, folder))


@register("load_time_factor", """WITH t AS (SELECT user_id, CASE WHEN rn <= w THEN 'web' WHEN rn <= w + a THEN 'application' WHEN rn <= w + a + d THEN 'database'
    WHEN rn <= w + a + d + b THEN 'batch' ELSE 'application' END AS server_type FROM (SELECT user_id, row_number() OVER (ORDER BY printf('USR-%04d', user_id)) AS rn,
    floor(n * 0.35::DOUBLE) AS w, floor(n * 0.40::DOUBLE) AS a, floor(n * 0.15::DOUBLE) AS d, floor(n * 0.10::DOUBLE) AS b
    FROM (SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL), (SELECT count(DISTINCT user_id)::DOUBLE AS n FROM events)))
    SELECT event_id AS reading_id, server_type, CASE WHEN hour(ts) BETWEEN 9 AND 17 THEN CASE server_type WHEN 'web' THEN 1.6 WHEN 'database' THEN 1.3
    WHEN 'application' THEN 1.5 ELSE 0.8 END ELSE 1.0 END::DOUBLE * CASE WHEN isodow(ts) >= 6 THEN CASE server_type WHEN 'web' THEN 0.5 WHEN 'database' THEN 0.7
    WHEN 'application' THEN 0.6 ELSE 1.2 END ELSE 1.0 END::DOUBLE AS load_factor FROM events JOIN t USING (user_id)""", ["load_factor"])
def load_time_factor(spark, folder):
    rows = panels.event_readings(spark, folder).select("server_id", "timestamp", "reading_id")
    typed = joins.join_metadata(rows, joins.assign_by_share(rows))
    return report.with_load_factor(typed).select("reading_id", "server_type", "load_factor")


_RAMP = """CASE WHEN month(timestamp) % 3 = 0 AND datediff('day', timestamp, last_day(timestamp)) <= 4
    THEN 1.0 + 0.3::DOUBLE * (5 - datediff('day', timestamp, last_day(timestamp))) / 5 ELSE 1.0 END"""


@register("quarter_ramp_factor", _days_sql(f"{_RAMP}::DOUBLE AS ramp"), ["ramp"])
def quarter_ramp_factor(spark, folder):
    return _days(spark, folder).withColumn("ramp", C.quarter_ramp_factor(T))


@register("holiday_load_factor", _days_sql("""(CASE WHEN month(timestamp) = 1 AND day(timestamp) = 1 THEN 0.5 WHEN month(timestamp) = 12 AND day(timestamp) >= 25 THEN 0.6
    WHEN month(timestamp) = 7 AND day(timestamp) = 4 THEN 0.7 WHEN month(timestamp) = 11 AND day(timestamp) BETWEEN 22 AND 28 THEN 0.7
    WHEN month(timestamp) = 12 AND day(timestamp) = 24 THEN 0.7 ELSE 1.0 END)::DOUBLE AS load_factor"""), ["load_factor"])
def holiday_load_factor(spark, folder):
    return _days(spark, folder).withColumn("load_factor", C.holiday_load_factor(T))


@register("seasonal_expectation", sql("metrics", f"""SELECT server_id, timestamp, e AS expectation, cpu_p95 / e AS cpu_deseasonalised FROM (SELECT *,
    CASE WHEN isodow(timestamp) >= 6 THEN 0.8::DOUBLE ELSE 1.0 END * (1 + 0.15::DOUBLE * sin(2 * pi() * dayofyear(timestamp) / 365.25::DOUBLE))
    * (1 + 0.2::DOUBLE * (datediff('day', lo, timestamp) / datediff('day', lo, hi)::DOUBLE)) * CASE WHEN {eoq_sql(T, 'fixed31')} = 1 THEN 1.25::DOUBLE ELSE 1.0 END
    * CASE WHEN {holiday_sql(T)} = 1 THEN 0.7::DOUBLE ELSE 1.0 END AS e FROM metrics, (SELECT min(timestamp) AS lo, max(timestamp) AS hi FROM metrics))"""),
    ["expectation", "cpu_deseasonalised"])
def seasonal_expectation(spark, folder):
    panel = panels.supplier_metrics(spark, folder)
    span = panels.supplier_readings(spark, folder).agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"))
    out = panel.withColumn("expectation", C.seasonal_expectation(T, span.select("lo").scalar(), span.select("hi").scalar()))
    return out.select("server_id", "timestamp", "expectation", (F.col("cpu_p95") / F.col("expectation")).alias("cpu_deseasonalised"))


@register("clip_metric", sql("spine", "SELECT server_id, timestamp, CASE WHEN cpu_p95 IS NOT NULL THEN greatest(20.0, least(80.0, cpu_p95)) END AS cpu_p95 FROM spine"), ["cpu_p95"])
def clip_metric(spark, folder):
    return panels.supplier_spine(spark, folder).select("server_id", "timestamp", N.clip("cpu_p95", 20.0, 80.0).alias("cpu_p95"))


@register("nonfinite_to_null_dropna", sql("metrics", "SELECT server_id, timestamp, mem_p95 / disk_p95 AS ratio FROM metrics WHERE disk_p95 <> 0"), ["ratio"], 8)
def nonfinite_to_null_dropna(spark, folder):
    d = F.col("disk_p95")
    ratio = F.when(d == 0, F.when(F.col("mem_p95") > 50, F.lit(float("inf"))).otherwise(F.lit(float("nan")))).otherwise(F.col("mem_p95") / F.nullif(d, F.lit(0.0)))
    return N.drop_incomplete(panels.supplier_metrics(spark, folder).select("server_id", "timestamp", ratio.alias("ratio")))


@register("range_filter", sql("readings", "SELECT server_id, timestamp, cpu_p95 FROM readings WHERE timestamp BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'"), ["cpu_p95"])
def range_filter(spark, folder):
    line = panels.table(spark, folder, "lineitem")
    lo, hi = F.lit("1998-01-01").cast("timestamp_ntz"), F.lit("1999-01-01").cast("timestamp_ntz")
    kept = line.filter((F.col("l_shipdate") >= lo) & (F.col("l_shipdate") < hi))
    return kept.select(N.padded_id("l_suppkey").alias("server_id"), F.to_date("l_shipdate").alias("timestamp"), (F.col("l_quantity") * 2.0).alias("cpu_p95"))


@register("entity_filter_first_n", sql("metrics", """SELECT server_id, timestamp, cpu_p95 FROM metrics WHERE server_id IN (
    SELECT DISTINCT server_id FROM metrics ORDER BY server_id LIMIT 5)"""), ["cpu_p95"])
def entity_filter_first_n(spark, folder):
    return joins.first_entities(panels.supplier_metrics(spark, folder).select("server_id", "timestamp", "cpu_p95"), 5)


@register("case_insensitive_match", sql("types", "SELECT server_id, upper(server_type) AS server_type FROM types WHERE lower(server_type) = 'web'"))
def case_insensitive_match(spark, folder):
    typed = joins.assign_by_share(panels.supplier_dimension(spark, folder)).withColumn("server_type", F.upper("server_type"))
    return typed.filter(F.lower("server_type") == "web")


@register("cascade_level", sql("readings", """SELECT reading_id, reading_line, CASE WHEN cpu_p95 > 96 THEN 'high' WHEN cpu_p95 > 80 THEN 'medium' ELSE 'low' END AS level FROM readings"""))
def cascade_level(spark, folder):
    rows = panels.supplier_readings(spark, folder)
    return rows.select("reading_id", "reading_line", N.level("cpu_p95", [(96.0, "high"), (80.0, "medium")], "low").alias("level"))


@register("select_numeric", sql("panel", "SELECT server_id, timestamp, cpu_p95, mem_p95, disk_p95, net_in_p95, net_out_p95 FROM panel"), METRICS)
def select_numeric(spark, folder):
    panel = panels.supplier_panel(spark, folder)
    return panel.select("server_id", "timestamp", *N.columns_of_type(panel, contains="_p95"))


@register("format_entity_id", "SELECT s_suppkey, printf('SRV-%04d', s_suppkey) AS server_id FROM supplier")
def format_entity_id(spark, folder):
    return panels.table(spark, folder, "supplier").select("s_suppkey", N.padded_id("s_suppkey").alias("server_id"))


@register("round_metrics", sql("metrics", "SELECT server_id, timestamp, round(mem_p95, 3) AS mem_p95, round(net_out_p95, 4) AS net_out_p95 FROM metrics"))
def round_metrics(spark, folder):
    panel = panels.supplier_metrics(spark, folder)
    return panel.select("server_id", "timestamp", F.round("mem_p95", 3).alias("mem_p95"), F.round("net_out_p95", 4).alias("net_out_p95"))


@register("period_distance", """SELECT event_id, datediff('day', CAST(ts AS DATE), last_day(CAST(date_trunc('quarter', ts) + INTERVAL 2 MONTH AS DATE))) AS days_to_quarter_end,
    CASE WHEN CAST(ts AS DATE) = last_day(ts) THEN 1 ELSE 0 END AS is_month_end, CASE WHEN hour(ts) BETWEEN 9 AND 17 THEN 1 ELSE 0 END AS is_business_hour FROM events""")
def period_distance(spark, folder):
    return panels.table(spark, folder, "events").select("event_id", *[e.alias(n) for n, e in C.period_distance("ts").items()])
