"""Checks and profiles, each in as few passes as its result allows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P
from ..functions.sizing import stored
from .quantiles import exact_quantiles, melt
from .segments import overall_totals, with_row_windows


def _rows(df: DataFrame, made: dict[str, list[Column]], names: Sequence[str], values: dict[str, str]) -> DataFrame:
    """One aggregate pass, exploded to a row per column."""
    one = df.agg(*[F.struct(*made[n]).alias(f"_{i}") for i, n in enumerate(names)])
    each = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(f"_{i}").alias("s")) for i, n in enumerate(names)])
    return one.select(F.explode(each).alias("_e")).select("_e.metric", *[F.col(f"_e.s.{v}").alias(a) for v, a in values.items()])


def missing_rates(df: DataFrame, columns: Sequence[str], limit: float = P.MISSING_WARN_PCT) -> DataFrame:
    """Percent NULL per column and whether it is above the limit."""
    pct = {c: [(F.avg(F.when(F.col(c).isNull(), 1.0).otherwise(0.0)) * 100).alias("p")] for c in columns}
    out = _rows(df, pct, columns, {"p": "missing_pct"})
    return out.withColumn("above_limit", F.col("missing_pct") > limit)


def describe_stats(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), probs: Sequence[float] = (0.05, 0.25, 0.5, 0.75, 0.95),
) -> DataFrame:
    """Count, mean, deviation, extremes and exact percentiles per metric (and key)."""
    # statistics and percentiles both read it
    long = stored(melt(df.select(*keys, *columns), columns, keys), "long")
    group = [*keys, "metric"]
    basic = long.groupBy(*group).agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    q = exact_quantiles(long, group, "value", probs)
    wide = q.groupBy(*group).agg(*[
        F.max(F.when(F.col("prob") == F.lit(float(p)), F.col("quantile"))).alias(f"p{round(p * 100):02d}") for p in probs])
    return basic.join(wide, group, "left")


def entity_history(df: DataFrame, required: int = P.MIN_HISTORY, entity: str = P.ENTITY) -> DataFrame:
    """Rows per server and whether it falls short of the required history."""
    return df.groupBy(entity).agg(F.count(F.lit(1)).alias("rows")).withColumn("too_short", F.col("rows") < required)


def row_count_expectation(df: DataFrame, tolerance: int = P.ROW_TOLERANCE, entity: str = P.ENTITY, ts: str = P.TS) -> DataFrame:
    """Rows against days times servers."""
    d = F.to_date(F.col(ts))
    per = df.groupBy(entity).agg(F.count(F.lit(1)).alias("_n"), F.min(d).alias("_lo"), F.max(d).alias("_hi"))
    days = F.datediff(F.max("_hi"), F.min("_lo")) + 1
    out = per.agg(F.sum("_n").alias("actual_rows"), (days * F.count(F.lit(1))).alias("expected_rows"))
    return out.withColumn("within_tolerance", F.abs(F.col("actual_rows") - F.col("expected_rows")) <= tolerance)


def validate_metrics(
    df: DataFrame, expected: Sequence[str], metrics: Sequence[str], date_col: str = P.TS,
    max_missing: float = 0.05, upper: float = 1.0, allow_negative: bool = False,
) -> DataFrame:
    """Issue list as rows ``check, column_name, failed``: schema checks, then one pass over the data."""
    absent = [c for c in expected if c not in df.columns]
    dated = date_col in df.columns and isinstance(df.schema[date_col].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
    checks = [("missing_column", c, F.lit(c in absent)) for c in expected]
    if date_col in df.columns:
        checks.append(("not_datetime", date_col, F.lit(not dated)))
    for c in df.columns:
        share = F.avg(F.when(F.col(c).isNull(), 1.0).otherwise(0.0))
        checks.append(("high_missing", c, F.coalesce(share > max_missing, F.lit(False))))
    for c in [m for m in metrics if m in df.columns]:
        if not allow_negative:
            checks.append(("negative_values", c, F.coalesce(F.bool_or(F.col(c) < 0), F.lit(False))))
        checks.append(("above_upper_limit", c, F.coalesce(F.bool_or(F.col(c) > upper), F.lit(False))))
    one = df.agg(*[e.alias(f"_{i}") for i, (_, _, e) in enumerate(checks)])
    each = F.array(*[
        F.struct(F.lit(k).alias("check"), F.lit(c).alias("column_name"), F.col(f"_{i}").alias("failed")) for i, (k, c, _) in enumerate(checks)
    ])
    return one.select(F.explode(each).alias("_e")).select("_e.*")


def profile_table(df: DataFrame, ts: str | None = P.TS) -> DataFrame:
    """One row per column: type, rows, missing count, numeric statistics, and the time span."""
    none = F.lit(None).cast("double")
    made, types = {}, {}
    for f in df.schema:
        number = isinstance(f.dataType, T.NumericType)
        c = F.col(f.name)
        made[f.name] = [
            F.lit("numeric" if number else "other").alias("kind"), F.count(F.lit(1)).alias("rows"), F.count_if(c.isNull()).alias("missing"),
            (F.avg(c) if number else F.max(none)).cast("double").alias("mean"), (F.stddev_samp(c) if number else F.max(none)).alias("std"),
            (F.min(c) if number else F.max(none)).cast("double").alias("min"), (F.max(c) if number else F.max(none)).cast("double").alias("max"),
            (F.datediff(F.max(c), F.min(c)) if f.name == ts else F.max(F.lit(None).cast("int"))).alias("span_days"),
        ]
    names = df.columns
    keep = ["kind", "rows", "missing", "mean", "std", "min", "max", "span_days"]
    return _rows(df, made, names, {k: k for k in keep}).withColumnRenamed("metric", "column_name")


def readiness_score(df: DataFrame, ts: str = P.TS) -> DataFrame:
    """0 to 5 points: enough rows (twice), a timestamp, two numeric columns, few missing; ready from 3."""
    numeric = sum(isinstance(f.dataType, T.NumericType) for f in df.schema)
    has_time = ts in df.columns
    missing = sum((F.avg(F.when(F.col(c).isNull(), 1.0).otherwise(0.0)) for c in df.columns), F.lit(0.0)) / len(df.columns) * 100
    one = df.agg(F.count(F.lit(1)).alias("rows"), missing.alias("missing_pct"))
    points = (
        F.when(F.col("rows") > 1000, 1).otherwise(0) + F.lit(int(has_time)) + F.lit(int(numeric >= 2))
        + F.when(F.col("missing_pct") < 5, 1).otherwise(0) + F.when(F.col("rows") > 10000, 1).otherwise(0)
    )
    return one.withColumn("score", points).withColumn("ready", F.col("score") >= 3)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier, fully equal row."""
    per = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(F.sum("_n").alias("rows"), (F.sum("_n") - F.count(F.lit(1))).alias("duplicate_rows"))


def dataset_overview(df: DataFrame, metrics: Sequence[str], entity: str = P.ENTITY, ts: str = P.TS) -> DataFrame:
    """Statistics and exact P95 per metric beside the table's records, servers and date span."""
    per = df.groupBy(entity).agg(F.count(F.lit(1)).alias("_n"), F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    whole = per.agg(F.sum("_n").alias("records"), F.count(F.lit(1)).alias("servers"), F.min("_lo").alias("first_day"), F.max("_hi").alias("last_day"))
    stats = describe_stats(df, metrics, probs=(0.95,)).select("metric", "mean", "std", "min", "max", "p95")
    return stats.withColumns({c: whole.select(c).scalar() for c in whole.columns})


def correlation_matrix(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Pearson matrix over pairwise complete rows, as ``a, b, correlation``."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    one = df.groupBy(*keys).agg(*[F.corr(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"_{i}").alias("correlation")))
    return one.select(*keys, F.explode(F.array(*cells)).alias("_e")).select(*keys, "_e.*")


def correlation_tolerance(left: DataFrame, right: DataFrame, tolerance: float = 0.15) -> DataFrame:
    """Two correlation matrices side by side and whether each pair agrees within the tolerance."""
    r = right.withColumnRenamed("correlation", "reference")
    both = left.join(r, ["a", "b"])
    return both.withColumn("within_tolerance", F.abs(F.col("correlation") - F.col("reference")) <= tolerance)


def target_correlation(df: DataFrame, target: str, features: Sequence[str]) -> DataFrame:
    """Correlation of each feature with the target, strongest first."""
    made = {f: [F.corr(target, f).alias("c")] for f in features}
    out = _rows(df, made, features, {"c": "correlation"}).withColumnRenamed("metric", "feature")
    return out.orderBy(F.desc_nulls_last(F.abs("correlation")), "feature")


def gap_check(df: DataFrame, days: int = 1, entity: str = P.ENTITY, ts: str = P.TS) -> DataFrame:
    """Gaps longer than ``days`` between consecutive rows of a server."""
    with_prev = with_row_windows(df.select(entity, ts), [entity], ts, 1, lambda w: {"gap_start": F.lag(ts, 1).over(w)})
    gap = F.datediff(F.col(ts), F.col("gap_start"))
    return with_prev.filter(gap > days).select(entity, "gap_start", F.col(ts).alias("gap_end"), gap.alias("gap_days"))


def iqr_outliers(df: DataFrame, columns: Sequence[str], factor: float = 1.5) -> DataFrame:
    """Flag, not remove, values outside the quartile fences of their metric."""
    q = exact_quantiles(melt(df, columns), ["metric"], "value", [0.25, 0.75])
    wide = q.agg(*[
        F.max(F.when((F.col("metric") == c) & (F.col("prob") == p), F.col("quantile"))).alias(f"{c}_{n}")
        for c in columns for p, n in ((0.25, "q1"), (0.75, "q3"))
    ])
    made = {}
    for c in columns:
        q1, q3 = wide.select(f"{c}_q1").scalar(), wide.select(f"{c}_q3").scalar()
        outside = (F.col(c) < q1 - factor * (q3 - q1)) | (F.col(c) > q3 + factor * (q3 - q1))
        made[f"is_iqr_outlier_{c}"] = F.coalesce(outside, F.lit(False))
    return df.withColumns(made)


def frequency_check(df: DataFrame, step_days: int = 1, entity: str = P.ENTITY, ts: str = P.TS) -> DataFrame:
    """Per server: rows, repeated timestamps, steps that are not the expected one, and the verdict."""
    per_time = df.groupBy(entity, ts).agg(F.count(F.lit(1)).alias("_n"))
    stepped = with_row_windows(per_time, [entity], ts, 1, lambda w: {"_before": F.lag(ts, 1).over(w)})
    wrong = F.count_if(F.datediff(F.col(ts), F.col("_before")) != step_days)
    out = stepped.groupBy(entity).agg(
        F.sum("_n").alias("rows"), F.sum(F.col("_n") - 1).alias("duplicate_timestamps"), wrong.alias("irregular_steps"))
    return out.withColumn("regular", (F.col("duplicate_timestamps") == 0) & (F.col("irregular_steps") == 0))


def autocorrelation(df: DataFrame, column: str, lags: Sequence[int], entity: str = P.ENTITY, ts: str = P.TS, regular: bool = False) -> DataFrame:
    """Correlation of a metric with its own value k rows earlier, per server and k."""
    shifted = with_row_windows(
        df.select(entity, ts, column), [entity], ts, max(lags), lambda w: {f"_lag{k}": F.lag(column, k).over(w) for k in lags}, regular)
    per = shifted.groupBy(entity).agg(*[F.corr(column, f"_lag{k}").alias(f"_c{k}") for k in lags])
    each = F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"_c{k}").alias("acf")) for k in lags])
    return per.select(entity, F.explode(each).alias("_e")).select(entity, "_e.*")


def ks_distance(df: DataFrame, source: str, value: str, first: str, second: str) -> DataFrame:
    """Kolmogorov-Smirnov distance and mean difference of two sources.

    Equal values are counted together first; the running shares then go over value bins.
    """
    held = df.filter(F.col(value).isNotNull() & F.col(source).isin(first, second))
    one = F.col(source) == first
    counts = held.groupBy(value).agg(F.count_if(one).alias("_a"), F.count_if(~one).alias("_b"))
    run = overall_totals(counts, value, {"_ra": F.col("_a"), "_rb": F.col("_b")})
    totals = held.agg(
        F.count_if(one).alias("na"), F.count_if(~one).alias("nb"),
        F.avg(F.when(one, F.col(value))).alias("ma"), F.avg(F.when(~one, F.col(value))).alias("mb"))
    na, nb = totals.select("na").scalar(), totals.select("nb").scalar()
    gap = F.max(F.abs(F.try_divide(F.col("_ra").cast("double"), na) - F.try_divide(F.col("_rb").cast("double"), nb)))
    out = run.agg(gap.alias("ks_distance"))
    return out.withColumn("mean_difference", totals.select("ma").scalar() - totals.select("mb").scalar())


def compare_before_after(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row loss, missing values and mean/deviation change per column across a transform."""
    def prof(df, tag):
        made = {c: [F.count(F.lit(1)).alias("r"), F.count_if(F.col(c).isNull()).alias("m"), F.avg(c).alias("a"), F.stddev_samp(c).alias("s")] for c in columns}
        return _rows(df, made, columns, {"r": f"rows_{tag}", "m": f"missing_{tag}", "a": f"mean_{tag}", "s": f"std_{tag}"})

    same = {c: before.schema[c].dataType == after.schema[c].dataType for c in columns}
    kept = F.create_map(*[F.lit(x) for c in columns for x in (c, same[c])])
    both = prof(before, "before").join(prof(after, "after"), "metric")
    return both.withColumns({
        "rows_lost": F.col("rows_before") - F.col("rows_after"), "same_type": kept[F.col("metric")],
        "mean_change": F.col("mean_after") - F.col("mean_before"),
    })


def load_summary(df: DataFrame, columns: Sequence[str], removed: Column, entity: str = P.ENTITY, ts: str = P.TS) -> DataFrame:
    """One record: servers, rows, date range, missing-rate map, duplicates removed."""
    rates = F.create_map(*[x for c in columns for x in (F.lit(c), F.round(F.avg(F.when(F.col(c).isNull(), 1.0).otherwise(0.0)) * 100, 2))])
    per = df.select(entity).distinct().agg(F.count(F.lit(1))).scalar()
    one = df.agg(
        F.count(F.lit(1)).alias("rows"), F.date_format(F.min(ts), "yyyyMMdd").alias("first_day"),
        F.date_format(F.max(ts), "yyyyMMdd").alias("last_day"), rates.alias("missing_rates"))
    return one.withColumns({"servers": per, "duplicates_removed": removed})


def generation_summary(df: DataFrame, entity: str = P.ENTITY) -> DataFrame:
    """Rows, servers, missing CPU percent, mean CPU and memory, exact P95 CPU."""
    # servers, means and the percentile all read it
    held = stored(df.select(entity, "cpu_p95", "mem_p95"), "panel")
    servers = held.select(entity).distinct().agg(F.count(F.lit(1))).scalar()
    p95 = exact_quantiles(held, [], "cpu_p95", [0.95]).select("quantile").scalar()
    one = held.agg(
        F.count(F.lit(1)).alias("rows"), (F.avg(F.when(F.col("cpu_p95").isNull(), 1.0).otherwise(0.0)) * 100).alias("missing_rate_cpu"),
        F.avg("cpu_p95").alias("mean_cpu_p95"), F.avg("mem_p95").alias("mean_mem_p95"))
    return one.withColumns({"unique_servers": servers, "p95_cpu_p95": p95})


def entity_count_check(df: DataFrame, expected: int | Column, entity: str = P.ENTITY) -> DataFrame:
    """Number of servers against the expected number."""
    found = df.select(entity).distinct().agg(F.count(F.lit(1)).alias("servers"))
    want = F.lit(expected) if isinstance(expected, int) else expected
    return found.withColumn("expected", want).withColumn("matches", F.col("servers") == F.col("expected"))


