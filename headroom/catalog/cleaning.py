"""Duplicates, gaps, outliers, warm-up rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean
from ..operators.segments import BUILT
from ..sources import panels
from .base import METRICS, interpolated, register, sql

_TWO = ["cpu_p95", "mem_p95"]


def _spine(spark, folder):
    return panels.supplier_spine(spark, folder).select("server_id", "timestamp", *_TWO)


@register("dedup_by_key", sql("readings", """SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY server_id, timestamp
    ORDER BY reading_id, reading_line) AS n FROM readings) WHERE n = 1"""), METRICS)
def dedup_by_key(spark, folder):
    return clean.dedup_by_key(panels.supplier_readings(spark, folder), tiebreak=["reading_id", "reading_line"])


@register("dedup_removed_count", sql("readings", """SELECT count(*) AS rows_in, count(DISTINCT (server_id, timestamp)) AS rows_out,
    count(*) - count(DISTINCT (server_id, timestamp)) AS duplicates_removed FROM readings"""))
def dedup_removed_count(spark, folder):
    return clean.duplicates_removed(panels.supplier_readings(spark, folder))


_UP = "OVER (PARTITION BY server_id ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_DOWN = "OVER (PARTITION BY server_id ORDER BY timestamp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


@register("fill_forward_backward", sql("spine", f"""SELECT server_id, timestamp, coalesce(last_value(cpu_p95 IGNORE NULLS) {_UP}, first_value(cpu_p95 IGNORE NULLS) {_DOWN}) AS cpu_p95,
    coalesce(last_value(mem_p95 IGNORE NULLS) {_UP}, first_value(mem_p95 IGNORE NULLS) {_DOWN}) AS mem_p95 FROM spine"""), _TWO)
def fill_forward_backward(spark, folder):
    return clean.fill_forward_backward(_spine(spark, folder), _TWO)


@register("interpolate_linear", sql("spine", interpolated(_TWO, "spine")), _TWO)
def interpolate_linear(spark, folder):
    return clean.interpolate_linear(_spine(spark, folder), _TWO, regular=BUILT)


@register("interpolate_forward_only", sql("sparse", interpolated(_TWO, "sparse", "forward")), _TWO)
def interpolate_forward_only(spark, folder):
    return clean.interpolate_linear(panels.supplier_sparse(spark, folder).drop("disk_p95"), _TWO, edges="forward")


@register("interpolate_then_edges", sql("sparse", interpolated([*_TWO, "disk_p95"], "sparse")), [*_TWO, "disk_p95"])
def interpolate_then_edges(spark, folder):
    return clean.interpolate_then_edges(panels.supplier_sparse(spark, folder), [*_TWO, "disk_p95"])


@register("clean_numeric", sql("sparse", interpolated(_TWO, "(SELECT server_id, timestamp, least(80.0, cpu_p95) AS cpu_p95, least(80.0, mem_p95) AS mem_p95 FROM sparse)", "forward")
          .replace("least(80.0, cpu_p95)", "CASE WHEN cpu_p95 IS NOT NULL THEN least(80.0, cpu_p95) END").replace("least(80.0, mem_p95)", "CASE WHEN mem_p95 IS NOT NULL THEN least(80.0, mem_p95) END")), _TWO)
def clean_numeric(spark, folder):
    return clean.clean_numeric(panels.supplier_sparse(spark, folder).drop("disk_p95"), _TWO, 0.0, 80.0, "interpolate")


@register("fill_fallback", sql("sparse", f"""SELECT server_id, timestamp, coalesce(last_value(cpu_p95 IGNORE NULLS) {_UP}, 0.0) AS cpu_p95,
    coalesce(last_value(mem_p95 IGNORE NULLS) {_UP}, 0.0) AS mem_p95 FROM sparse"""), _TWO)
def fill_fallback(spark, folder):
    return clean.fill_fallback(panels.supplier_sparse(spark, folder).drop("disk_p95"), _TWO)


_ALL = "OVER (ORDER BY server_id, timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@register("fill_fallback_table", sql("sparse", f"""SELECT server_id, timestamp, coalesce(last_value(cpu_p95 IGNORE NULLS) {_ALL}, 0.0) AS cpu_p95,
    coalesce(last_value(mem_p95 IGNORE NULLS) {_ALL}, 0.0) AS mem_p95 FROM sparse"""), _TWO)
def fill_fallback_table(spark, folder):
    return clean.fill_fallback(panels.supplier_sparse(spark, folder).drop("disk_p95"), _TWO, scope="table")


@register("fill_by_type", sql("spine dim", """SELECT s.server_id, timestamp, coalesce(region, 'Unknown') AS region, coalesce(cpu_p95, 0) AS cpu_p95, coalesce(mem_p95, 0) AS mem_p95
    FROM spine s LEFT JOIN (SELECT * FROM dim WHERE criticality = 'High') d ON s.server_id = d.server_id"""), _TWO)
def fill_by_type(spark, folder):
    high = panels.supplier_dimension(spark, folder).filter("criticality = 'High'").select("server_id", "region")
    return clean.fill_by_type(_spine(spark, folder).join(high, "server_id", "left").select("server_id", "timestamp", "region", *_TWO))


@register("impute_median", sql("sparse", """SELECT server_id, timestamp, coalesce(cpu_p95, median(cpu_p95) OVER (PARTITION BY server_id)) AS cpu_p95,
    coalesce(mem_p95, median(mem_p95) OVER (PARTITION BY server_id)) AS mem_p95 FROM sparse"""), _TWO)
def impute_median(spark, folder):
    return clean.impute_median(panels.supplier_sparse(spark, folder).drop("disk_p95"), _TWO)


_KNN = sql("sparse", """SELECT * FROM sparse""").replace("SELECT * FROM sparse", """, r AS (SELECT *, row_number() OVER (PARTITION BY server_id ORDER BY timestamp) AS i FROM sparse),
    d AS (SELECT a.server_id, a.i, b.i AS j, b.cpu_p95 AS c, b.mem_p95 AS m, b.disk_p95 AS k, a.cpu_p95 IS NULL AS nc, a.mem_p95 IS NULL AS nm,
    round(sqrt(3.0::DOUBLE / nullif((a.cpu_p95 IS NOT NULL AND b.cpu_p95 IS NOT NULL)::INT + (a.mem_p95 IS NOT NULL AND b.mem_p95 IS NOT NULL)::INT + 1, 0)
    * (coalesce((a.cpu_p95 - b.cpu_p95) * (a.cpu_p95 - b.cpu_p95), 0) + coalesce((a.mem_p95 - b.mem_p95) * (a.mem_p95 - b.mem_p95), 0) + (a.disk_p95 - b.disk_p95) * (a.disk_p95 - b.disk_p95))), 9) AS dist
    FROM r a JOIN r b ON a.server_id = b.server_id WHERE a.cpu_p95 IS NULL OR a.mem_p95 IS NULL),
    fc AS (SELECT server_id, i, avg(c) AS v FROM (SELECT server_id, i, c, row_number() OVER (PARTITION BY server_id, i ORDER BY dist, j) AS n FROM d WHERE nc AND c IS NOT NULL) WHERE n <= 5 GROUP BY 1, 2),
    fm AS (SELECT server_id, i, avg(m) AS v FROM (SELECT server_id, i, m, row_number() OVER (PARTITION BY server_id, i ORDER BY dist, j) AS n FROM d WHERE nm AND m IS NOT NULL) WHERE n <= 5 GROUP BY 1, 2)
    SELECT r.server_id, r.timestamp, coalesce(r.cpu_p95, fc.v, avg(r.cpu_p95) OVER (PARTITION BY r.server_id)) AS cpu_p95,
    coalesce(r.mem_p95, fm.v, avg(r.mem_p95) OVER (PARTITION BY r.server_id)) AS mem_p95, r.disk_p95
    FROM r LEFT JOIN fc ON r.server_id = fc.server_id AND r.i = fc.i LEFT JOIN fm ON r.server_id = fm.server_id AND r.i = fm.i""")


@register("impute_knn", _KNN.replace(") , r AS", "), r AS"), [*_TWO, "disk_p95"])
def impute_knn(spark, folder):
    return clean.impute_knn(panels.supplier_sparse(spark, folder), ["cpu_p95", "mem_p95", "disk_p95"])


@register("winsorize_rolling_z", sql("capped", "SELECT * FROM capped"), METRICS)
def winsorize_rolling_z(spark, folder):
    filled = clean.interpolate_linear(panels.supplier_spine(spark, folder), METRICS, regular=BUILT)
    return clean.winsorize_rolling_z(filled, METRICS, regular=BUILT)


@register("rolling_anomaly_score", sql("metrics", """SELECT server_id, timestamp, CASE WHEN s > 1e-9 THEN (cpu_p95 - m) / s END AS cpu_p95_anomaly_score FROM (
    SELECT *, avg(cpu_p95) OVER w AS m, stddev_samp(cpu_p95) OVER w AS s FROM metrics WINDOW w AS (PARTITION BY server_id ORDER BY timestamp ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))"""),
    ["cpu_p95_anomaly_score"])
def rolling_anomaly_score(spark, folder):
    panel = panels.supplier_metrics(spark, folder).select("server_id", "timestamp", "cpu_p95")
    return clean.rolling_anomaly_score(panel, ["cpu_p95"]).drop("cpu_p95")


@register("zscore_flags", sql("metrics", """SELECT server_id, timestamp, coalesce(abs((cpu_p95 - (SELECT avg(cpu_p95) FROM metrics)) / (SELECT stddev_samp(cpu_p95) FROM metrics)) > 1.5, false) AS is_outlier_cpu_p95,
    coalesce(abs((mem_p95 - (SELECT avg(mem_p95) FROM metrics)) / (SELECT stddev_samp(mem_p95) FROM metrics)) > 1.5, false) AS is_outlier_mem_p95 FROM metrics"""))
def zscore_flags(spark, folder):
    panel = panels.supplier_metrics(spark, folder).select("server_id", "timestamp", *_TWO)
    return clean.zscore_flags(panel, _TWO, 1.5).drop(*_TWO)


@register("warmup_drop", sql("metrics", """SELECT server_id, timestamp, cpu_p95 FROM (SELECT *, row_number() OVER (PARTITION BY server_id ORDER BY timestamp) AS n FROM metrics)
    WHERE n > 90"""), ["cpu_p95"])
def warmup_drop(spark, folder):
    return clean.warmup_drop(panels.supplier_metrics(spark, folder).select("server_id", "timestamp", "cpu_p95"), 90)


_RAW = """SELECT printf('SRV-%04d', l_suppkey) AS server_id, CAST(l_shipdate AS DATE) AS timestamp, l_orderkey AS reading_id, l_linenumber AS reading_line,
    CASE WHEN l_linestatus = 'O' THEN l_returnflag END AS state, CASE WHEN l_returnflag <> 'R' THEN l_quantity * 2.0 END AS cpu_p95 FROM lineitem
    WHERE l_suppkey IS NOT NULL AND l_shipdate IS NOT NULL"""


@register("clean_panel_legacy", f"""WITH raw AS ({_RAW}), one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY server_id, timestamp ORDER BY reading_id, reading_line) AS n FROM raw) WHERE n = 1)
    SELECT server_id, timestamp, reading_id, reading_line, coalesce(state, 'Unknown') AS state, coalesce(last_value(cpu_p95 IGNORE NULLS) {_UP}, first_value(cpu_p95 IGNORE NULLS) {_DOWN}, 0) AS cpu_p95 FROM one""",
    ["cpu_p95"])
def clean_panel_legacy(spark, folder):
    line = panels.table(spark, folder, "lineitem").filter(F.col("l_suppkey").isNotNull() & F.col("l_shipdate").isNotNull())
    raw = line.select(
        F.format_string("SRV-%04d", "l_suppkey").alias("server_id"), F.to_date("l_shipdate").alias("timestamp"), F.col("l_orderkey").alias("reading_id"),
        F.col("l_linenumber").alias("reading_line"), F.when(F.col("l_linestatus") == "O", F.col("l_returnflag")).alias("state"),
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity") * 2.0).alias("cpu_p95"))
    return clean.clean_panel_legacy(raw, ["reading_id", "reading_line"])


@register("quality_flag", sql("spine clean", """SELECT server_id, timestamp, cpu_p95, CASE WHEN s > 1e-9 AND abs((cpu_p95 - m) / s) > 2 THEN 2 WHEN miss THEN 1 ELSE 0 END AS quality_flag FROM (
    SELECT c.server_id, c.timestamp, c.cpu_p95, s.cpu_p95 IS NULL AS miss, avg(c.cpu_p95) OVER w AS m, stddev_samp(c.cpu_p95) OVER w AS s
    FROM clean c JOIN spine s ON c.server_id = s.server_id AND c.timestamp = s.timestamp
    WINDOW w AS (PARTITION BY c.server_id ORDER BY c.timestamp ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))"""), ["cpu_p95"])
def quality_flag(spark, folder):
    before = panels.supplier_spine(spark, folder).select("server_id", "timestamp", "cpu_p95")
    filled = clean.interpolate_linear(before, ["cpu_p95"], regular=BUILT)
    scored = clean.rolling_anomaly_score(filled, ["cpu_p95"], regular=BUILT)
    marked = scored.withColumn("_far", F.coalesce(F.abs("cpu_p95_anomaly_score") > 2, F.lit(False))).drop("cpu_p95_anomaly_score")
    return clean.quality_flag(before, "cpu_p95", marked, "_far").drop("_far")
