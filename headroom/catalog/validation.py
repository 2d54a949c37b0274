"""Validation and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean, features, validate
from ..operators.segments import BUILT
from ..sources import panels
from .base import METRICS, register, sql



def _union(template: str, names=METRICS) -> str:
    return " UNION ALL ".join(template.replace("{m}", m) for m in names)


@register("missing_rates", sql("spine", _union("""SELECT '{m}' AS metric, avg(CASE WHEN {m} IS NULL THEN 1.0 ELSE 0.0 END) * 100 AS missing_pct,
    avg(CASE WHEN {m} IS NULL THEN 1.0 ELSE 0.0 END) * 100 > 5 AS above_limit FROM spine""")), ["missing_pct"])
def missing_rates(spark, folder):
    return validate.missing_rates(panels.supplier_spine(spark, folder), METRICS)


_DESCRIBE = """SELECT '{m}' AS metric, count({m}) AS count, avg({m}) AS mean, stddev_samp({m}) AS std, min({m}) AS min, max({m}) AS max, quantile_cont({m}, 0.05) AS p05,
    quantile_cont({m}, 0.25) AS p25, quantile_cont({m}, 0.5) AS p50, quantile_cont({m}, 0.75) AS p75, quantile_cont({m}, 0.95) AS p95 FROM """
_STATS = ["mean", "std", "min", "max", "p05", "p25", "p50", "p75", "p95"]


@register("describe_stats", sql("metrics", _union(_DESCRIBE + "metrics")), _STATS, 5)
def describe_stats(spark, folder):
    return validate.describe_stats(panels.supplier_metrics(spark, folder), METRICS)


@register("describe_by_group", sql("panel", _union(_DESCRIBE.replace("SELECT", "SELECT business_unit,") + "panel GROUP BY business_unit", ["cpu_p95", "mem_p95"])), _STATS, 5)
def describe_by_group(spark, folder):
    return validate.describe_stats(panels.supplier_panel(spark, folder), ["cpu_p95", "mem_p95"], ["business_unit"])


@register("entity_history_check", sql("metrics", "SELECT server_id, count(*) AS rows, count(*) < 520 AS too_short FROM metrics GROUP BY 1"))
def entity_history_check(spark, folder):
    return validate.entity_history(panels.supplier_metrics(spark, folder), 520)


@register("row_count_expectation", sql("metrics", """SELECT count(*) AS actual_rows, (datediff('day', min(timestamp), max(timestamp)) + 1) * count(DISTINCT server_id) AS expected_rows,
    abs(count(*) - (datediff('day', min(timestamp), max(timestamp)) + 1) * count(DISTINCT server_id)) <= 100 AS within_tolerance FROM metrics"""))
def row_count_expectation(spark, folder):
    return validate.row_count_expectation(panels.supplier_metrics(spark, folder))


_CHECKS = " UNION ALL ".join(
    [f"SELECT 'missing_column' AS \"check\", '{c}' AS column_name, {str(c == 'gpu_p95').lower()} AS failed FROM one" for c in ("server_id", "timestamp", *METRICS, "gpu_p95")]
    + ["SELECT 'not_datetime', 'timestamp', false FROM one"]
    + [f"SELECT 'high_missing', '{c}', avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) > 0.05 FROM spine" for c in ("server_id", "timestamp", *METRICS)]
    + [f"SELECT 'negative_values', '{c}', coalesce(bool_or({c} < 0), false) FROM spine" for c in METRICS]
    + [f"SELECT 'above_upper_limit', '{c}', coalesce(bool_or({c} > 90), false) FROM spine" for c in METRICS])


@register("validate_metrics", sql("spine", "SELECT * FROM (" + _CHECKS.replace("FROM one", "FROM (SELECT count(*) FROM spine) AS one") + ")"))
def validate_metrics(spark, folder):
    return validate.validate_metrics(panels.supplier_spine(spark, folder), ["server_id", "timestamp", *METRICS, "gpu_p95"], METRICS, upper=90.0)


_PROFILE = " UNION ALL ".join(
    [f"""SELECT '{c}' AS column_name, 'other' AS kind, count(*) AS rows, count(*) - count({c}) AS missing, NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS min,
    NULL::DOUBLE AS max, {span} AS span_days FROM spine""" for c, span in (("server_id", "NULL::INT"), ("timestamp", "datediff('day', min(timestamp), max(timestamp))"))]
    + [f"SELECT '{c}', 'numeric', count(*), count(*) - count({c}), avg({c}), stddev_samp({c}), min({c}), max({c}), NULL FROM spine" for c in METRICS])


@register("profile_table", sql("spine", _PROFILE), ["mean", "std", "min", "max"], 5)
def profile_table(spark, folder):
    return validate.profile_table(panels.supplier_spine(spark, folder))


@register("readiness_score", sql("spine", f"""SELECT *, (rows > 1000)::INT + 1 + 1 + (missing_pct < 5)::INT + (rows > 10000)::INT AS score,
    (rows > 1000)::INT + 1 + 1 + (missing_pct < 5)::INT + (rows > 10000)::INT >= 3 AS ready FROM (SELECT count(*) AS rows, (
    {' + '.join(f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)" for c in ('server_id', 'timestamp', *METRICS))}) / 7 * 100 AS missing_pct FROM spine)"""), ["missing_pct"])
def readiness_score(spark, folder):
    return validate.readiness_score(panels.supplier_spine(spark, folder))


@register("duplicate_rows", sql("readings", "SELECT sum(n)::BIGINT AS rows, (sum(n) - count(*))::BIGINT AS duplicate_rows FROM (SELECT count(*) AS n FROM readings GROUP BY server_id, timestamp, cpu_p95)"))
def duplicate_rows(spark, folder):
    return validate.duplicate_rows(panels.supplier_readings(spark, folder).select("server_id", "timestamp", "cpu_p95"))


@register("dataset_overview", sql("metrics", _union("""SELECT '{m}' AS metric, avg({m}) AS mean, stddev_samp({m}) AS std, min({m}) AS min, max({m}) AS max, quantile_cont({m}, 0.95) AS p95,
    count(*) AS records, count(DISTINCT server_id) AS servers, min(timestamp) AS first_day, max(timestamp) AS last_day FROM metrics""")), ["mean", "std", "min", "max", "p95"], 5)
def dataset_overview(spark, folder):
    return validate.dataset_overview(panels.supplier_metrics(spark, folder), METRICS)


@register("distinct_entities", sql("readings", "SELECT count(DISTINCT server_id) AS servers FROM readings"))
def distinct_entities(spark, folder):
    return panels.supplier_readings(spark, folder).select("server_id").distinct().agg(F.count(F.lit(1)).alias("servers"))


@register("load_summary")
def load_summary(spark, folder):
    removed = clean.duplicates_removed(panels.supplier_readings(spark, folder)).select("duplicates_removed").scalar()
    return validate.load_summary(panels.supplier_spine(spark, folder), METRICS, removed)


@register("generation_summary", sql("spine", """SELECT count(*) AS rows, avg(CASE WHEN cpu_p95 IS NULL THEN 1.0 ELSE 0.0 END) * 100 AS missing_rate_cpu, avg(cpu_p95) AS mean_cpu_p95,
    avg(mem_p95) AS mean_mem_p95, count(DISTINCT server_id) AS unique_servers, quantile_cont(cpu_p95, 0.95) AS p95_cpu_p95 FROM spine"""), ["missing_rate_cpu", "mean_cpu_p95", "mean_mem_p95", "p95_cpu_p95"])
def generation_summary(spark, folder):
    return validate.generation_summary(panels.supplier_spine(spark, folder))


@register("feature_summary", sql("spine", """SELECT count(*) AS input_rows, (count(*) - 90 * count(DISTINCT server_id)) AS output_rows, 2 + 2 + 10 + 16 + 2 + 5 + 1 AS columns, 10 AS lag_columns, 16 AS rolling_columns FROM spine"""))
def feature_summary(spark, folder):
    daily = panels.supplier_spine(spark, folder).select("server_id", "timestamp", "cpu_p95", "mem_p95")
    matrix = features.feature_matrix(daily, metrics=["cpu_p95", "mem_p95"], windows=(7, 90), regular=BUILT)
    lag, roll = features.lag_rolling_counts(matrix.columns)
    return daily.agg(F.count(F.lit(1)).alias("input_rows")).withColumns({
        "output_rows": matrix.agg(F.count(F.lit(1))).scalar(), "columns": F.lit(len(matrix.columns)), "lag_columns": F.lit(lag), "rolling_columns": F.lit(roll)})


def _corr_sql(table: str, names) -> str:
    return " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, {'corr(' + a + ', ' + b + ')'} AS correlation FROM {table}" for a in names for b in names)


@register("correlation_matrix", sql("metrics", _corr_sql("metrics", METRICS)), ["correlation"])
def correlation_matrix(spark, folder):
    return validate.correlation_matrix(panels.supplier_metrics(spark, folder), METRICS)


_THREE = ("cpu_p95", "mem_p95", "disk_p95")


@register("correlation_tolerance", sql("metrics sparse", f"""SELECT l.a, l.b, l.correlation, r.correlation AS reference, abs(l.correlation - r.correlation) <= 0.15 AS within_tolerance
    FROM ({_corr_sql('metrics', _THREE)}) l JOIN ({_corr_sql('sparse', _THREE)}) r ON l.a = r.a AND l.b = r.b"""), ["correlation", "reference"])
def correlation_tolerance(spark, folder):
    left = validate.correlation_matrix(panels.supplier_metrics(spark, folder), _THREE)
    return validate.correlation_tolerance(left, validate.correlation_matrix(panels.supplier_sparse(spark, folder), _THREE))


@register("target_correlation", sql("metrics", " UNION ALL ".join(f"SELECT '{m}' AS feature, corr(cpu_p95, {m}) AS correlation FROM metrics" for m in METRICS if m != "cpu_p95")), ["correlation"])
def target_correlation(spark, folder):
    return validate.target_correlation(panels.supplier_metrics(spark, folder), "cpu_p95", [m for m in METRICS if m != "cpu_p95"])


@register("gap_check", sql("metrics", """SELECT server_id, b AS gap_start, timestamp AS gap_end, datediff('day', b, timestamp) AS gap_days FROM (
    SELECT server_id, timestamp, lag(timestamp) OVER (PARTITION BY server_id ORDER BY timestamp) AS b FROM metrics) WHERE datediff('day', b, timestamp) > 7"""))
def gap_check(spark, folder):
    return validate.gap_check(panels.supplier_metrics(spark, folder), 7)


_FENCE = "{m} < (SELECT quantile_cont({m}, 0.25) - 0.4 * (quantile_cont({m}, 0.75) - quantile_cont({m}, 0.25)) FROM metrics) OR {m} > (SELECT quantile_cont({m}, 0.75) + 0.4 * (quantile_cont({m}, 0.75) - quantile_cont({m}, 0.25)) FROM metrics)"


@register("iqr_outliers", sql("metrics", f"""SELECT server_id, timestamp, {', '.join(f"coalesce({_FENCE.replace('{m}', m)}, false) AS is_iqr_outlier_{m}" for m in ('cpu_p95', 'mem_p95'))} FROM metrics"""))
def iqr_outliers(spark, folder):
    panel = panels.supplier_metrics(spark, folder).select("server_id", "timestamp", "cpu_p95", "mem_p95")
    return validate.iqr_outliers(panel, ["cpu_p95", "mem_p95"], 0.4).drop("cpu_p95", "mem_p95")


@register("frequency_check", sql("readings", """SELECT server_id, sum(n)::BIGINT AS rows, sum(n - 1)::BIGINT AS duplicate_timestamps, count(*) FILTER (WHERE d <> 1) AS irregular_steps,
    sum(n - 1) = 0 AND count(*) FILTER (WHERE d <> 1) = 0 AS regular FROM (SELECT server_id, n, datediff('day', lag(timestamp) OVER (PARTITION BY server_id ORDER BY timestamp), timestamp) AS d
    FROM (SELECT server_id, timestamp, count(*) AS n FROM readings GROUP BY 1, 2)) GROUP BY 1"""))
def frequency_check(spark, folder):
    return validate.frequency_check(panels.supplier_readings(spark, folder).select("server_id", "timestamp"))


@register("autocorrelation", sql("cpu", " UNION ALL ".join(f"""SELECT server_id, {k} AS lag, corr(cpu_p95, l{k}) AS acf FROM (SELECT *, lag(cpu_p95, {k}) OVER (PARTITION BY server_id ORDER BY timestamp) AS l{k}
    FROM cpu) GROUP BY 1""" for k in (1, 7, 30))), ["acf"])
def autocorrelation(spark, folder):
    daily = panels.supplier_spine(spark, folder).select("server_id", "timestamp", "cpu_p95")
    return validate.autocorrelation(clean.interpolate_linear(daily, ["cpu_p95"], regular=BUILT), "cpu_p95", [1, 7, 30], regular=BUILT)


@register("ks_distance", sql("panel", """SELECT max(abs(fa - fb)) AS ks_distance, any_value(ma - mb) AS mean_difference FROM (
    SELECT sum(a) OVER w / sum(a) OVER () AS fa, sum(b) OVER w / sum(b) OVER () AS fb, (SELECT avg(mem_p95) FROM panel WHERE criticality = 'High') AS ma,
    (SELECT avg(mem_p95) FROM panel WHERE criticality = 'Low') AS mb FROM (SELECT mem_p95 AS v, sum((criticality = 'High')::INT)::DOUBLE AS a, sum((criticality = 'Low')::INT)::DOUBLE AS b
    FROM panel WHERE criticality IN ('High', 'Low') GROUP BY 1) WINDOW w AS (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""), ["ks_distance", "mean_difference"])
def ks_distance(spark, folder):
    return validate.ks_distance(panels.supplier_panel(spark, folder), "criticality", "mem_p95", "High", "Low")


@register("compare_before_after", sql("spine clean", _union("""SELECT '{m}' AS metric, b.r AS rows_before, b.m AS missing_before, b.a AS mean_before, b.s AS std_before, c.r AS rows_after, c.m AS missing_after,
    c.a AS mean_after, c.s AS std_after, b.r - c.r AS rows_lost, true AS same_type, c.a - b.a AS mean_change FROM
    (SELECT count(*) AS r, count(*) - count({m}) AS m, avg({m}) AS a, stddev_samp({m}) AS s FROM spine) b, (SELECT count(*) AS r, count(*) - count({m}) AS m, avg({m}) AS a, stddev_samp({m}) AS s FROM clean) c""",
    ["cpu_p95", "mem_p95"])), ["mean_before", "std_before", "mean_after", "std_after", "mean_change"])
def compare_before_after(spark, folder):
    two = ["cpu_p95", "mem_p95"]
    before = panels.supplier_spine(spark, folder).select("server_id", "timestamp", *two)
    return validate.compare_before_after(before, clean.interpolate_linear(before, two, regular=BUILT), two)


@register("entity_count_check", sql("readings", """SELECT count(DISTINCT server_id) AS servers, (SELECT count(*) FROM supplier) AS expected,
    count(DISTINCT server_id) = (SELECT count(*) FROM supplier) AS matches FROM readings"""))
def entity_count_check(spark, folder):
    expected = panels.table(spark, folder, "supplier").agg(F.count(F.lit(1))).scalar()
    return validate.entity_count_check(panels.supplier_readings(spark, folder), expected)
