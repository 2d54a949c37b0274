"""Golden values, edge cases, and brute-force checks on small fixtures."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from headroom.functions import calendar as C
from headroom.functions import numeric as N
from headroom.operators import clean, evaluate, features, forecast, joins, knn, quantiles, regularise, risk, segments, validate


def day(text):
    return dt.date.fromisoformat(text)


def series(n, start="2023-01-01", seed=1, servers=2, holes=0.2):
    rng = np.random.default_rng(seed)
    rows = []
    for s in range(servers):
        for i in range(n):
            v = None if rng.random() < holes else float(np.round(rng.uniform(0, 100), 3))
            rows.append((f"s{s}", day(start) + dt.timedelta(days=i), v))
    return rows


SCHEMA = "server_id string, timestamp date, cpu double"


def test_calendar_golden(spark):
    df = spark.createDataFrame([(day(d),) for d in ("2024-01-01", "2024-03-31", "2024-07-04")], "timestamp date")
    got = {str(r.timestamp): (r.is_eoq, r.is_holiday) for r in C.calendar_features(df).collect()}
    assert got["2024-01-01"] == (0, 1) and got["2024-03-31"][0] == 1 and got["2024-07-04"] == (0, 1)


def test_holiday_count(spark):
    days = C.holiday_calendar(spark, F.lit("1995-01-01").cast("date"), F.lit("2025-12-31").cast("date"))
    found = {str(r[0]) for r in days.collect()}
    assert len(found) == 351 and {"2021-12-31", "2021-12-24"} <= found


def test_ramp_and_eoq(spark):
    df = spark.createDataFrame([(day(f"2024-06-{d:02d}"),) for d in range(20, 31)], "timestamp date")
    out = df.select(F.dayofmonth("timestamp").alias("d"), C.quarter_ramp_factor("timestamp").alias("r"), C.eoq_window("timestamp").alias("e"),
                    C.eoq_window("timestamp", variant="fixed31").alias("f")).orderBy("d").collect()
    assert [round(r.r, 2) for r in out[-5:]] == [1.06, 1.12, 1.18, 1.24, 1.30]
    assert [r.d for r in out if r.e] == list(range(24, 31)) and [r.d for r in out if r.f] == list(range(25, 31))


def test_clip_and_missing(spark):
    df = spark.createDataFrame([(-0.5,), (1.5,), (None,), (float("nan"),)], "cpu double")
    assert [r[0] for r in df.select(N.clip(N.finite("cpu"), 0.0, 1.0)).collect()] == [0.0, 1.0, None, None]


@pytest.mark.parametrize("hours", [24, 24 * 7, 24 * 512])
def test_fills_match_pandas_across_segments(spark, hours):
    rows = series(60)
    df = spark.createDataFrame(rows, SCHEMA)
    pdf = pd.DataFrame(rows, columns=["server_id", "timestamp", "cpu"])
    grouped = pdf.groupby("server_id")["cpu"]
    want = grouped.transform(lambda g: g.interpolate(limit_direction="both")).round(9).tolist()
    got = clean.interpolate_linear(df, ["cpu"], hours=hours).orderBy("server_id", "timestamp").collect()
    assert [round(r.cpu, 9) for r in got] == want
    want = grouped.transform(lambda g: g.ffill().bfill()).tolist()
    got = clean.fill_forward_backward(df, ["cpu"], hours=hours).orderBy("server_id", "timestamp").collect()
    assert [r.cpu for r in got] == want


@pytest.mark.parametrize("rows_per_chunk", [8, 64])
def test_rolling_matches_pandas_across_chunks(spark, rows_per_chunk, monkeypatch):
    from headroom.operators import rolling as R

    rows = series(50)
    df = spark.createDataFrame(rows, SCHEMA)
    pdf = pd.DataFrame(rows, columns=["server_id", "timestamp", "cpu"])
    names = [f"cpu_roll_{s}_7d" for s in features.STATS]
    got = R.with_chunk_kernel(df, lambda v: R.rolling(v, ["cpu"], [7], features.STATS), ["cpu"], names, 6, rows=rows_per_chunk, hours=24 * 9)
    got = got.orderBy("server_id", "timestamp").toPandas()
    for s in features.STATS:
        want = pdf.groupby("server_id")["cpu"].transform(lambda x: getattr(x.rolling(7, min_periods=1), s)())
        np.testing.assert_allclose(got[f"cpu_roll_{s}_7d"].to_numpy(float), want.to_numpy(float), atol=1e-8)


def test_running_totals_and_positions(spark):
    df = spark.createDataFrame(series(40, holes=0), SCHEMA)
    out = segments.with_position(features.cumulative_sum(df, ["cpu"], hours=24 * 5), ["server_id"], "timestamp", hours=24 * 3)
    pdf = out.orderBy("server_id", "timestamp").toPandas()
    np.testing.assert_allclose(pdf["cpu_cumulative"], pdf.groupby("server_id")["cpu"].cumsum())
    assert pdf["position"].tolist() == list(range(1, 41)) * 2


def test_exact_quantiles_by_selection(spark):
    """Hot, tied and small groups, and rows without a key, beside numpy; 400 values are already too many to sort."""
    rng = np.random.default_rng(3)
    groups = {
        "hot": rng.normal(size=3000).round(4), "tied": np.concatenate([np.full(2500, 7.0), rng.normal(7, 1, 60)]), "one": np.full(900, 2.5),
        "steps": rng.integers(0, 4, 2000).astype(float), None: rng.lognormal(0, 4, 1500), "cold": np.array([1.0, 2.0]), "gone": np.array([]),
    }
    rows = [(k, float(v)) for k, x in groups.items() for v in x] + [("gone", None), ("cold", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    probs = [0.0, 0.003, 0.25, 0.5, 0.95, 0.9999, 1.0]
    got = {(r.k, r.prob): r.quantile for r in quantiles.exact_quantiles(df, ["k"], "v", probs, accuracy=400, cuts=8).collect()}
    assert len(got) == 6 * len(probs)
    for k, x in groups.items():
        for p in probs if len(x) else ():
            assert got[k, p] == pytest.approx(np.quantile(x, p), rel=1e-12), (k, p)
    every = np.concatenate(list(groups.values()))
    whole = quantiles.exact_quantiles(df, [], "v", [0.1, 0.95], accuracy=100, cuts=20).collect()
    assert [r.quantile for r in sorted(whole)] == [pytest.approx(np.quantile(every, p), rel=1e-12) for p in (0.1, 0.95)]
    assert quantiles.exact_quantiles(df.filter("v IS NULL"), [], "v", [0.5]).count() == 0


def test_resample(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 8), 0.5), ("a", dt.datetime(2024, 1, 1, 12), 0.9), ("a", dt.datetime(2024, 1, 3, 8), 0.4)],
                               "server_id string, timestamp timestamp_ntz, cpu double")
    assert [r.cpu for r in regularise.resample_daily(df, ["cpu"]).orderBy("timestamp").collect()] == [0.9, None, 0.4]
    assert [r.cpu for r in regularise.resample_daily(df, ["cpu"], "sum").orderBy("timestamp").collect()] == [1.4, 0.0, 0.4]


def test_outliers(spark):
    df = spark.createDataFrame([(i, 10.0 if i == 50 else 0.5 + 0.001 * (i % 7), 1.0) for i in range(100)], "i int, val double, const double")
    out = clean.zscore_flags(df, ["val", "const"]).collect()
    assert sum(r.is_outlier_val for r in out) == 1 and not any(r.is_outlier_const for r in out)


def test_dedup_keeps_first(spark):
    df = spark.createDataFrame([("a", 1, 2, "x"), ("a", 1, 1, "y"), ("b", 1, 5, "z")], "server_id string, timestamp int, id int, v string")
    assert sorted(r.v for r in clean.dedup_by_key(df, tiebreak=["id"]).collect()) == ["y", "z"]


def plain_knn(x, k):
    want = x.copy()
    for i, j in zip(*np.where(np.isnan(x))):
        both = ~np.isnan(x) & ~np.isnan(x[i])
        with np.errstate(divide="ignore", invalid="ignore"):
            d = np.sqrt(x.shape[1] / both.sum(1) * np.where(both, (x - x[i]) ** 2, 0).sum(1)).round(9)
        able = [r for r in np.argsort(np.where(both.any(1), d, np.inf), kind="stable") if not np.isnan(x[r, j]) and both[r].any()][:k]
        want[i, j] = x[able, j].mean() if able else np.nanmean(x[:, j])
    return want


def knn_frame(spark, x, names, server="a"):
    rows = [(server, day("2024-01-01") + dt.timedelta(days=i), *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, f"server_id string, timestamp date, {', '.join(f'{c} double' for c in names)}").repartition(3)


@pytest.mark.parametrize("cell, shape", [(6, "even"), (6, "tails"), (4, "steps"), (16, "alone"), (1000, "tails")])
def test_knn_against_brute_force(spark, cell, shape):
    """Exact however wide the cells are: even values, long tails with far outliers, few distinct values, rows nobody shares a value with."""
    rng = np.random.default_rng(5)
    x = rng.uniform(0, 10, (150, 4)).round(2)
    if shape == "tails":
        x = (rng.lognormal(0, 2.5, (150, 4)) * [1, 10, 100, 1]).round(3)
    elif shape == "steps":
        x = rng.integers(0, 3, (150, 4)).astype(float)
    x[rng.random(x.shape) < 0.25] = np.nan
    if shape == "alone":
        x[:40], x[40:, 3] = np.nan, np.nan
        x[:20, 3] = 1.0
    got = clean.impute_knn(knn_frame(spark, x, "abcd"), list("abcd"), 3, cell_rows=cell).orderBy("timestamp").toPandas()[list("abcd")].to_numpy()
    np.testing.assert_allclose(got, plain_knn(x, 3))


def test_knn_work_grows_with_the_rows(spark):
    """Pairs compared in the first round and receivers left after it, for one server at 1, 2 and 4 times the rows."""
    pairs = []
    for n in (1000, 2000, 4000):
        rng = np.random.default_rng(n)
        x = rng.normal(size=(n, 3)).round(4)
        x[rng.random(n) < 0.2, 0] = np.nan
        placed = knn_frame(spark, x, "abc").withColumn("_rid", F.datediff("timestamp", F.lit("2023-12-31")).cast("long"))
        cases = knn.Cases([6, 7], 3)
        donors = knn._members(placed, list("abc"), cases, cases.donors, "server_id")
        grids = knn._grids(donors, "server_id", 2, 16)
        d = knn.donor_cells(knn._binned(donors, grids, "server_id"), 0)
        r = knn.receiver_cells(knn._binned(knn._members(placed, list("abc"), cases, cases.receivers, "server_id"), grids, "server_id"), 0)
        cell = ["server_id", "_case", "_c0", "_c1", "_c2"]
        many = lambda df, c: df.groupBy(*cell).agg(F.count(F.lit(1)).alias(c))
        pairs.append(many(r, "r").join(many(d, "d"), cell).agg(F.sum(F.col("r") * F.col("d"))).first()[0])
    assert pairs[2] < 6 * pairs[0] and pairs[2] < 0.2 * 800 * 3200, pairs


def test_knn_hot_cell(spark):
    """More donors and receivers in one cell than a task should hold are dealt over several."""
    x = np.column_stack([np.random.default_rng(1).normal(size=120).round(5), np.zeros(120), np.arange(120) % 3])
    x[::3, 0] = np.nan
    got = clean.impute_knn(knn_frame(spark, x, "abc"), list("abc"), 4, cell_rows=5).orderBy("timestamp").toPandas()[list("abc")].to_numpy()
    np.testing.assert_allclose(got, plain_knn(x, 4))
    assert clean.impute_knn(knn_frame(spark, x[:0], "abc"), list("abc")).count() == 0


def test_assign_by_share(spark):
    df = spark.createDataFrame([(f"s{i:03d}",) for i in range(120)], "server_id string")
    got = dict(joins.assign_by_share(df).groupBy("server_type").count().collect())
    assert got == {"web": 42, "application": 48, "database": 18, "batch": 12}


def test_errors_and_risk(spark):
    df = spark.createDataFrame([("a", "m", 1.0, 1.0), ("a", "m", 2.0, 2.0), ("a", "m", 3.0, 4.0), ("a", "m", 0.0, 0.0)], "server_id string, model string, actual double, predicted double")
    assert evaluate.error_metrics(df.filter("actual > 0")).first().mae == pytest.approx(0.3333)
    flags = risk.risk_flags(spark.createDataFrame([(0.8,), (0.95,), (None,)], "predicted double"), 0.9).collect()
    assert [r.risk_flag for r in flags] == [False, True, False] and [r.risk_level for r in flags] == ["low", "medium", "low"]


def test_clusters(spark):
    df = spark.createDataFrame([("a", .1, .1), ("b", .1, .1), ("c", .9, .9), ("d", .9, .9)], "server_id string, predicted_mean double, predicted_std double")
    got = {r.server_id: r.cluster for r in risk.cluster_servers(df, ["predicted_mean", "predicted_std"], 2).collect()}
    assert got == {"a": 0, "b": 0, "c": 1, "d": 1}


def test_validator(spark):
    df = spark.createDataFrame([("a", day("2024-01-01"), -1.0), ("a", day("2024-01-02"), 2.0)], SCHEMA)
    failed = {(r.check, r.column_name) for r in validate.validate_metrics(df, ["server_id", "timestamp", "mem"], ["cpu"]).collect() if r.failed}
    assert failed == {("missing_column", "mem"), ("negative_values", "cpu"), ("above_upper_limit", "cpu")}


def test_forecast_rows(spark):
    df = spark.createDataFrame(series(500, "2022-01-01", holes=0), SCHEMA)
    out = forecast.forecast_table(df, "cpu", "2023-03-01", 10, min_rows=365)
    test_days = 500 - (day("2023-03-01") - day("2022-01-01")).days
    assert out.count() == 2 * len(forecast.MODELS) * (test_days + 10)
    assert forecast.forecast_table(df, "cpu", "2022-06-01", 10, min_rows=365).count() == 0


def test_ks_and_fallback(spark):
    rng = np.random.default_rng(8)
    a, b = rng.normal(size=200).round(2), rng.normal(0.5, 1, 200).round(2)
    df = spark.createDataFrame([("a", float(v)) for v in a] + [("b", float(v)) for v in b], "src string, v double")
    grid = np.unique(np.concatenate([a, b]))
    want = max(abs((a <= g).mean() - (b <= g).mean()) for g in grid)
    assert validate.ks_distance(df, "src", "v", "a", "b").first().ks_distance == pytest.approx(want)


@pytest.mark.parametrize("kind", ["five days apart", "repeated"])
def test_feature_matrix_by_rows(spark, kind):
    """2,200 rows of one server, more than a chunk: lags, means and sums by row, with days missing or repeated."""
    rng = np.random.default_rng(8)
    n = 2200
    days = [5 * k if kind == "five days apart" else k - k // 7 for k in range(n)]
    x = np.round(rng.uniform(20, 80, n), 3)
    rows = [("s0", day("1990-01-01") + dt.timedelta(days=d), float(v)) for d, v in zip(days, x)]
    rows = sorted(rows, key=lambda r: r[1:])
    x = np.array([r[2] for r in rows])
    hole = 1000
    rows[hole] = (*rows[hole][:2], None)
    if kind == "repeated":
        # a row without a value comes first among those of its day
        same = [k for k in range(n) if rows[k][1] == rows[hole][1]]
        rest = [x[k] for k in same if k != hole]
        x[same[1:]] = rest
        hole = same[0]
    x[hole] = (x[hole - 1] + x[hole + 1]) / 2
    if kind == "repeated":
        x[same] = np.sort(x[same])  # the filled value is in the order of the values
    out = features.feature_matrix(spark.createDataFrame(rows, SCHEMA), metrics=["cpu"], lags=(1, 7), windows=(7, 30), outlier_z=50.0).toPandas()
    want = pd.DataFrame({"cpu": x})
    want["cpu_lag_1d"], want["cpu_lag_7d"] = want.cpu.shift(1), want.cpu.shift(7)
    want["cpu_roll_mean_7d"], want["cpu_roll_mean_30d"], want["cpu_cumulative"] = want.cpu.rolling(7).mean(), want.cpu.rolling(30).mean(), want.cpu.cumsum()
    want = want.iloc[30:]
    got = out.sort_values("cpu_cumulative")[list(want.columns)]
    assert len(got) == n - 30
    np.testing.assert_allclose(got.to_numpy(), want.to_numpy(), rtol=1e-9)


def test_block_matrix(spark):
    """All days of all servers, days before 1970, several readings a day and a server without a name included."""
    rng = np.random.default_rng(2)
    rows = [(s, day("1969-10-01") + dt.timedelta(days=int(d)), int(rng.integers(0, 3))) for s in ("a", "b", None) for d in np.sort(rng.choice(400, 150, replace=False))]
    codes = spark.createDataFrame(rows + [("lone", day("2030-05-05"), 2), ("a", None, 1)], "server_id string, timestamp date, risk_code int")
    blocks = risk.sparse_blocks(codes, days=7)
    sizes = [len(r.cells) for r in blocks.collect()]
    assert max(sizes) <= 7 and sum(sizes) == len(rows) + 1
    cells = risk.matrix_days(risk.matrix_blocks(blocks, 0)).collect()
    axis = {r[1] for r in rows} | {day("2030-05-05")}
    want = {(s, d): 0 for s in ("a", "b", None, "lone") for d in axis} | {(s, d): c for s, d, c in rows} | {("lone", day("2030-05-05")): 2}
    assert {(r.server_id, r.timestamp): r.risk_code for r in cells} == want and len(cells) == len(want)
    assert sum(v is None for r in risk.matrix_blocks(blocks).collect() for v in r["values"]) == len(want) - len(rows) - 1
    hours = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, h), h) for h in (9, 3, 5)], "server_id string, timestamp timestamp_ntz, risk_code int")
    assert [r.cells for r in risk.sparse_blocks(hours).collect()] == [{19723: 3}]
    assert risk.matrix_blocks(risk.sparse_blocks(codes.limit(0))).count() == 0


def plain_adf(y, lags, most):
    """t of the level by dense least squares, over the rows that ``most`` lags leave; and the AIC."""
    d = np.diff(y)
    rows = np.arange(most, len(d))
    x = np.column_stack([np.ones(len(rows)), y[rows], *[d[rows - i] for i in range(1, lags + 1)]])
    beta, *_ = np.linalg.lstsq(x, d[rows], rcond=None)
    rss = ((d[rows] - x @ beta) ** 2).sum()
    error = np.sqrt(rss / (len(rows) - x.shape[1]) * np.linalg.inv(x.T @ x)[1, 1])
    return beta[1] / error, len(rows) * np.log(rss / len(rows)) + 2 * x.shape[1]


@pytest.mark.parametrize("lags", [0, 2, 5])
def test_augmented_stationarity(spark, lags):
    rng = np.random.default_rng(8)
    walk, noise = np.cumsum(rng.normal(size=300)) + 50, np.zeros(300)
    for i in range(2, 300):
        noise[i] = 0.5 * noise[i - 1] - 0.4 * noise[i - 2] + rng.normal()
    made = {"walk": walk, "noise": noise + 900, "trend": np.arange(300) + noise, "flat": np.full(300, 3.0), "short": walk[: lags + 2]}
    rows = [(k, day("2020-01-01") + dt.timedelta(days=3 * i), float(v)) for k, y in made.items() for i, v in enumerate(y)] + [("walk", day("2019-01-01"), None)]
    df = spark.createDataFrame(rows, "server_id string, timestamp date, cpu double").repartition(3)
    fixed = {r.server_id: r for r in forecast.augmented_stationarity(df, "cpu", lags, choose=False).collect()}
    chosen = {r.server_id: r for r in forecast.augmented_stationarity(df, "cpu", lags).collect()}
    for k in ("walk", "noise", "trend"):
        assert fixed[k].is_stationary == (plain_adf(made[k], lags, lags)[0] < -2.86)
        assert fixed[k].adf_statistic == pytest.approx(plain_adf(made[k], lags, lags)[0], rel=1e-6) and fixed[k].observations == 299 - lags
        best = min(range(lags + 1), key=lambda p: plain_adf(made[k], p, lags)[1])
        assert chosen[k].lags == best and chosen[k].adf_statistic == pytest.approx(plain_adf(made[k], best, lags)[0], rel=1e-6)
    assert fixed["noise"].is_stationary and fixed["noise"].p_value < 1e-4 and not fixed["trend"].is_stationary and fixed["trend"].p_value > 0.5
    for k in ("flat", "short"):
        assert fixed[k].adf_statistic is None and fixed[k].p_value is None and not fixed[k].is_stationary
    # published 1, 5 and 10 % points of the statistic
    points = spark.createDataFrame([(-3.43,), (-2.86,), (-2.57,)], "t double").select(forecast.unit_root_p_value(F.col("t")).alias("p")).collect()
    assert [round(r.p, 2) for r in points] == [0.01, 0.05, 0.1]


@pytest.mark.parametrize("kind", ["daily", "five", "repeated", "balanced"])
def test_regular_is_checked(spark, kind):
    """Panels said to be regular that are not: days five apart, a repeated day, a missing and a repeated one."""
    days = {"daily": range(40), "five": range(0, 200, 5), "repeated": [*range(40), 39], "balanced": [*range(39), 38]}[kind]
    days = [0, 1, 2, *days[4:]] + [days[-1]] if kind == "balanced" else list(days)
    rows = [("a", day("2023-12-01") + dt.timedelta(days=d), None if i % 6 == 2 else float(i * i % 17)) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert segments.gap_free(df, ["server_id"], "timestamp") == (kind == "daily")
    values = [r[2] for r in rows]
    if kind in ("daily", "five"):
        made = segments.with_row_windows(df, ["server_id"], "timestamp", 3, lambda w: {"back": F.lag("cpu", 3).over(w)}, True, rows=8).orderBy("timestamp").collect()
        assert [r.back for r in made] == [None] * 3 + values[:-3]
        got = [r.cpu for r in clean.interpolate_linear(df, ["cpu"], regular=True).orderBy("timestamp").collect()]
        np.testing.assert_allclose(got, pd.Series(values).interpolate(limit_direction="both"))
    else:
        assert clean.interpolate_linear(df, ["cpu"], regular=True).where("cpu IS NULL").count() == 0
    lagged = features.lag_features(df, ["cpu"], (1, 3), regular=True)
    assert lagged.count() == len(rows) and lagged.where("cpu_lag_3d IS NOT NULL").count() == sum(v is not None for v in values[:-3])


def test_rolling_origin(spark):
    """Folds in any order, overlapping horizons, missing values and a short server, beside plain means."""
    rng = np.random.default_rng(4)
    rows = [(s, day("2021-01-01") + dt.timedelta(days=i), None if rng.random() < 0.1 else float(rng.normal())) for s, n in (("a", 400), ("b", 90)) for i in range(n)]
    cuts = ["2021-12-01", "2021-04-15", "2021-11-20"]
    got = forecast.rolling_origin(spark.createDataFrame(rows, SCHEMA).repartition(3), "cpu", cuts, 30, 100).collect()
    want = {}
    for fold, cut in enumerate(map(day, cuts), 1):
        train = [r for r in rows if r[0] == "a" and r[1] < cut]
        for s, d, v in rows:
            if s == "a" and len(train) >= 100 and cut <= d < cut + dt.timedelta(days=30):
                same = [y for _, t, y in train if t.weekday() == d.weekday() and y is not None]
                want[fold, d] = (v, pytest.approx(np.mean(same)))
    assert {(r.fold, r.timestamp): (r.actual, r.predicted) for r in got} == want and len(got) == len(want) and {f for f, _ in want} == {1, 2, 3}


def _exchanges(df):
    """The partitionings that the plan of a table shuffles rows by."""
    text = df._jdf.queryExecution().executedPlan().toString().replace("== Initial Plan ==", "\n== Initial Plan ==").split("== Initial Plan ==")[-1]
    return [line for line in text.splitlines() if "Exchange " in line and "Reused" not in line and "Broadcast" not in line]


def test_calendar_is_filled_behind_the_shuffle(spark):
    """Gaps of any length, repeated days and rows without a server or day; only rows that are there get shuffled."""
    days = [("a", "2020-01-01", 1.0), ("a", "2020-01-04", None), ("a", "2024-02-28", 4.0), ("b", "2021-05-05", 5.0), ("c", None, 6.0), ("d", "2020-03-01", 7.0), ("d", "2020-03-01", 8.0), (None, "2020-01-01", 9.0), (None, "2020-01-03", 9.0)]
    df = spark.createDataFrame([(s, d and day(d), v) for s, d, v in days], SCHEMA)
    full = regularise.fill_calendar(df)
    got = full.toPandas()
    assert len(got) == (day("2024-02-28") - day("2020-01-01")).days + 1 + 1 + 2 + 3 and not got.timestamp.isna().any()
    assert sorted(got.dropna().itertuples(index=False, name=None)) == [("a", day("2020-01-01"), 1.0), ("a", day("2024-02-28"), 4.0), ("b", day("2021-05-05"), 5.0), ("d", day("2020-03-01"), 7.0), ("d", day("2020-03-01"), 8.0)]
    filled = clean.interpolate_linear(full.filter("server_id = 'a'"), ["cpu"], regular=segments.BUILT)
    assert len(_exchanges(filled)) == 1
    line = filled.orderBy("timestamp").toPandas().cpu
    assert line.to_numpy() == pytest.approx(np.linspace(1.0, 4.0, len(line)))


def test_forecast_shuffles_no_day_of_a_bucketed_panel(spark):
    """Cells, coefficients and the test days' join read the panel as it lies; rows equal those of a panel in rows."""
    from headroom.functions.sizing import stored_by

    df = spark.createDataFrame(series(500, "2022-01-01", holes=0), SCHEMA)
    panel = stored_by(df, "server_id", "panel")
    assert sorted(panel.collect()) == sorted(df.collect())
    assert _exchanges(forecast.coefficients(forecast.cells(panel, "cpu", "2023-03-01"), "2023-03-01")) == []
    one = forecast.forecast_table(panel, "cpu", "2023-03-01", 10, salts=1)
    two = forecast.forecast_table(df, "cpu", "2023-03-01", 10)
    key = lambda r: (r.server_id, r.model, r.timestamp)
    one, two = sorted(one.collect(), key=key), sorted(two.collect(), key=key)
    assert list(map(key, one)) == list(map(key, two)) and [r.predicted for r in one] == pytest.approx([r.predicted for r in two])


def test_clusters_read_the_forecasts_once(spark):
    """k-means goes over the profile many times: what it is made from is read once."""
    seen = spark.sparkContext.accumulator(0)
    rows = spark.sparkContext.parallelize([("a", .1, .1), ("b", .1, .1), ("c", .9, .9), ("d", .9, .9)], 1)
    df = spark.createDataFrame(rows.map(lambda r: (seen.add(1), r)[1]), "server_id string, predicted_mean double, predicted_std double")
    assert {r.servers for r in risk.cluster_summary(risk.cluster_servers(df, ["predicted_mean", "predicted_std"], 2)).collect()} == {2}
    assert seen.value == 4


def test_trees_fit_merged_rows(spark):
    """Rows that no split tells apart are one weighted row: boosting finds the same trees, and each kind of row is scored once."""
    rng = np.random.default_rng(5)
    rows = [(f"s{s}", day("2021-01-01") + dt.timedelta(days=i), float(20 + s % 7 * 10 + (i % 7) * (s % 3) + rng.normal())) for s in range(70) for i in range(500)]
    df = spark.createDataFrame(rows, SCHEMA)
    stats = forecast.tree_stats(df, "cpu", "2022-04-01")
    train = forecast.tree_training(df, "cpu", "2022-04-01", stats=stats).cache()
    bins = forecast.tree_bins(train)
    merged = forecast.merged_training(train, bins).cache()
    assert merged.count() < train.count() / 1.5
    assert merged.agg(F.sum("weight")).first()[0] == train.agg(F.sum("weight")).first()[0] == 70 * 455
    one, two = (forecast.tree_model("gradient_boost", 5, 4, bins=bins).fit(t) for t in (merged, train))
    ahead = forecast.tree_rows(df, "cpu", "2022-04-01", 10, stats=stats)
    scored = forecast.score_model(one, ahead, "m").orderBy("server_id", "timestamp").toPandas()
    plain = one.transform(ahead).orderBy("server_id", "timestamp").toPandas()
    assert len(scored) == len(plain) == 70 * 55 and scored.predicted.to_numpy() == pytest.approx(plain.predicted.to_numpy(), rel=1e-12)
    assert scored.predicted.to_numpy() == pytest.approx(two.transform(ahead).orderBy("server_id", "timestamp").toPandas().predicted.to_numpy(), rel=1e-9)
    forest = forecast.fit_trees(train, "random_forest", 5, 4)
    found = {r.feature: r.importance for r in forecast.feature_importance(spark, forest).collect()}
    assert set(found) == set(forecast.TREE_FEATURES) and sum(found.values()) == pytest.approx(1.0) and found["server_mean"] + found["weekday_mean_y"] > 0.9


def test_quantile_rows_are_never_sent_to_all(spark):
    """A stored column of few values is a tiny file of many rows: brackets go to the rows, not rows to the driver."""
    from headroom.functions.sizing import stored

    data = stored(spark.range(300_000).select((F.col("id") % 3).cast("double").alias("_x")), "values")
    brackets = spark.createDataFrame([(0.0, 2.0)] * 2000, "_low double, _high double")
    inside = (F.col("_x") >= F.col("_low")) & (F.col("_x") <= F.col("_high"))
    plan = lambda few: quantiles._attach(data, brackets, [], inside, few=few)._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in plan(True) and "BuildLeft" not in plan(True)
    assert "Broadcast" not in plan(False) and "SortMergeJoin" in plan(False)
    got = quantiles.exact_quantiles(data.select("_x"), [], "_x", [0.3, 0.5, 0.95]).orderBy("prob").collect()
    assert [r.quantile for r in got] == [0.0, 1.0, 2.0]


def test_built_panels_are_shuffled_once(spark):
    """Interpolation, capping and the feature matrix work where the filled calendar lies; the matrix equals that by rows."""
    rows = [r for r in series(400, "2022-01-01", holes=0.3) if r[2] is not None]
    df = spark.createDataFrame(rows, SCHEMA)
    full = regularise.fill_calendar(df)
    filled = clean.interpolate_linear(full, ["cpu"], regular=segments.BUILT)
    assert len(_exchanges(clean.winsorize_rolling_z(filled, ["cpu"], regular=segments.BUILT))) == 1
    meta = spark.createDataFrame([("s0", "x"), ("s1", "y")], "server_id string, kind string")
    made = dict(metrics=["cpu"], lags=(1, 7), windows=(7, 30), category_values={"kind": ["x", "y"]})
    one = features.feature_matrix(full, meta.hint("merge"), regular=segments.BUILT, **made)
    # one shuffle of the observed rows, one of the metadata; two more find the first day
    assert len(_exchanges(one)) == 4
    one, two = (m.orderBy("server_id", "timestamp").toPandas() for m in (one, features.feature_matrix(full, meta, **made)))
    assert list(one.columns) == list(two.columns) and len(one) == len(two) > 600
    for c in one.columns:
        assert (one[c] == two[c]).all() if one[c].dtype == object else one[c].to_numpy() == pytest.approx(two[c].to_numpy(), rel=1e-9)
