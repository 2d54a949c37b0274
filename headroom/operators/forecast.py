"""Forecasts as grouped aggregates.

One pass over the history reduces it to *cells*: per server, split, weekday, month and calendar
flags, the count and the sums of time, value and their products. A server has at most a few
hundred cells however long or dense its history is, the reduction happens before the shuffle,
and every model below is fitted from the cells alone.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P
from ..functions import calendar as C
from ..functions.sizing import stored
from .segments import attach_entity_stats, with_position, with_row_windows

MODELS = ("baseline", "additive", "naive", "ses", "theta")


def _cut(cut: str | date) -> Column:
    return F.lit(str(cut)).cast("date")


def split_label(df: DataFrame, cut: str, ts: str = P.TS) -> DataFrame:
    """Add ``split``: 'train' before the cut date, 'test' from it on."""
    return df.withColumn("split", F.when(F.to_date(F.col(ts)) < _cut(cut), "train").otherwise("test"))


def split_fraction(df: DataFrame, fraction: float, entity: str = P.ENTITY, ts: str = P.TS) -> DataFrame:
    """Add ``split`` by share of each server's rows in time order."""
    many = df.groupBy(entity).agg(F.count(F.lit(1)).alias("_n"))
    placed = attach_entity_stats(with_position(df, [entity], ts, name="_pos"), many, [entity], "_pos")
    head = F.col("_pos") <= F.floor(F.col("_n") * F.lit(fraction))
    return placed.withColumn("split", F.when(head, "train").otherwise("test")).drop("_pos", "_n")


def eligible(df: DataFrame, cut: str, min_rows: int = P.MIN_HISTORY, entity: str = P.ENTITY, ts: str = P.TS) -> DataFrame:
    """Servers with enough training rows and at least one test row."""
    train = F.to_date(F.col(ts)) < _cut(cut)
    counts = df.groupBy(entity).agg(F.count_if(train).alias("train_rows"), F.count_if(~train).alias("test_rows"))
    return counts.filter((F.col("train_rows") >= min_rows) & (F.col("test_rows") > 0))


def history_gate(df: DataFrame, cut: str, min_rows: int = P.MIN_HISTORY, entity: str = P.ENTITY, ts: str = P.TS) -> DataFrame:
    """Only the rows of eligible servers."""
    return df.join(eligible(df, cut, min_rows, entity, ts), entity, "left_semi")


def future_days(df: DataFrame, horizon: int = P.HORIZON, entity: str = P.ENTITY, ts: str = P.TS) -> DataFrame:
    """The ``horizon`` days after each server's last day."""
    last = df.groupBy(entity).agg(F.max(F.to_date(F.col(ts))).alias("_last"))
    days = F.sequence(F.date_add("_last", 1), F.date_add("_last", horizon), F.expr("INTERVAL 1 DAY"))
    return last.select(entity, F.explode(days).alias(ts))


def era_days(alpha: float) -> int:
    """So many days back, exponential weights are still far from the smallest double."""
    return max(1, int(600 / -math.log(1.0 - alpha))) if alpha < 1 else 1


def cells(
    df: DataFrame, target: str, cut: str, alpha: float = P.SES_ALPHA, entity: str = P.ENTITY, ts: str = P.TS,
) -> DataFrame:
    """Sufficient statistics per server, split, weekday, month and calendar flags.

    Time ``x`` is counted in days from the cut; ``sw`` holds values under exponential weights, which count
    from the end of an ``era`` of some years.
    """
    d = F.to_date(F.col(ts))
    y = F.col(target).cast("double")
    x = F.datediff(d, _cut(cut)).cast("double")
    rows = df.filter(F.col(entity).isNotNull()).select(
        F.col(entity), (d < _cut(cut)).alias("train"), C.weekday(d).alias("weekday"), F.month(d).alias("month"),
        C.eoq_window(d).alias("eoq"), C.is_holiday(d).alias("holiday"), d.alias("day"), x.alias("x"), y.alias("y"),
        F.floor(-x / F.lit(era_days(alpha))).alias("era"),
    )
    # weights count from the end of the row's era, so that old ones do not all become 0
    rows = rows.withColumn("age", F.pow(F.lit(1.0 - alpha), -F.col("x") - F.col("era") * F.lit(era_days(alpha))))
    held = F.when(F.col("y").isNotNull(), F.col("day"))
    seen = F.when(F.col("y").isNotNull(), F.col("x"))
    return rows.groupBy(entity, "train", "weekday", "month", "eoq", "holiday", "era").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("y").alias("n"), F.sum(seen).alias("sx"), F.sum("y").alias("sy"),
        F.sum(seen * seen).alias("sxx"), F.sum(F.col("x") * F.col("y")).alias("sxy"),
        F.sum(F.col("y") * F.col("y")).alias("syy"), F.sum(F.col("age") * F.col("y")).alias("sw"),
        F.max("day").alias("last_day"),
        F.min(held).alias("first_held"), F.max(held).alias("last_held"),
        F.min_by("y", held).alias("first_y"), F.max_by("y", held).alias("last_y"),
    )


def coefficients(
    cell: DataFrame, cut: str, min_rows: int = P.MIN_HISTORY, alpha: float = P.SES_ALPHA, entity: str = P.ENTITY,
) -> DataFrame:
    """One row per eligible server with everything the models need to predict any date.

    The additive model is a linear trend, then weekday, month, quarter-end, holiday and weekend
    effects, each the mean of what the parts before it leave; its spread is the deviation of the
    final residual. All of it follows from the cell sums.
    """
    by = Window.partitionBy(entity)
    total = lambda c, w=by: F.sum(c).over(w)
    counted = cell.withColumns({
        "_train_rows": total(F.when(F.col("train"), F.col("rows")).otherwise(0)),
        "_test_rows": total(F.when(~F.col("train"), F.col("rows")).otherwise(0)),
        "_end": F.max("last_day").over(by),
    })
    kept = counted.filter(F.col("train") & (F.col("_train_rows") >= min_rows) & (F.col("_test_rows") > 0))
    sums = kept.withColumns({f"_{s}": total(s) for s in ("n", "sx", "sy", "sxx", "sxy")})
    slope = F.try_divide(
        F.col("_n") * F.col("_sxy") - F.col("_sx") * F.col("_sy"), F.col("_n") * F.col("_sxx") - F.col("_sx") * F.col("_sx")
    )
    fit = sums.withColumn("slope", slope).withColumn("intercept", (F.col("_sy") - F.col("slope") * F.col("_sx")) / F.col("_n"))
    fit = fit.withColumn("left", F.col("sy") - F.col("intercept") * F.col("n") - F.col("slope") * F.col("sx"))
    fit = fit.withColumn("fixed", F.col("intercept"))
    by_weekday, by_month = Window.partitionBy(entity, "weekday"), Window.partitionBy(entity, "month")
    one = F.lit(True)
    steps = [
        ("e_weekday", one, by_weekday), ("e_month", one, by_month), ("e_eoq", F.col("eoq") == 1, by),
        ("e_holiday", F.col("holiday") == 1, by), ("e_weekend", F.col("weekday") >= 5, by),
    ]
    for name, hit, w in steps:
        effect = F.try_divide(total(F.when(hit, F.col("left")), w), total(F.when(hit, F.col("n")), w).cast("double"))
        fit = fit.withColumn(name, F.coalesce(effect, F.lit(0.0)))
        part = F.when(hit, F.col(name)).otherwise(0.0)
        fit = fit.withColumns({"left": F.col("left") - part * F.col("n"), "fixed": F.col("fixed") + part})
    e, b = F.col("fixed"), F.col("slope")
    square = (
        F.col("syy") - 2 * e * F.col("sy") - 2 * b * F.col("sxy") + F.col("n") * e * e + 2 * e * b * F.col("sx") + b * b * F.col("sxx")
    )
    fit = fit.withColumns({
        "weekday_mean": F.try_divide(total("sy", by_weekday), total("n", by_weekday).cast("double")), "square": square,
    })
    # from the end of the cell's era to the server's last day; eras long before it weigh nothing
    shift = F.datediff(F.max("last_held").over(by), _cut(cut)) + F.col("era") * F.lit(era_days(alpha))
    fit = fit.withColumn("_sw", F.col("sw") * F.pow(F.lit(1.0 - alpha), shift.cast("double")))
    pairs = lambda k, v: F.map_from_entries(F.collect_set(F.struct(F.col(k), F.col(v))))
    packed = fit.groupBy(entity).agg(
        F.max("_train_rows").alias("train_rows"), F.max("_end").alias("last_day"),
        F.sum("n").alias("n"), F.max("slope").alias("slope"), F.max("intercept").alias("intercept"),
        pairs("weekday", "weekday_mean").alias("weekday_mean"),
        pairs("weekday", "e_weekday").alias("weekday_effect"), pairs("month", "e_month").alias("month_effect"),
        F.max("e_eoq").alias("eoq_effect"), F.max("e_holiday").alias("holiday_effect"), F.max("e_weekend").alias("weekend_effect"),
        F.sum("left").alias("_r"), F.sum("square").alias("_rr"), F.sum("_sw").alias("_sw"),
        F.min("first_held").alias("_first"), F.max("last_held").alias("last_train_day"),
        F.min_by("first_y", "first_held").alias("_first_y"), F.max_by("last_y", "last_held").alias("last_value"),
    )
    variance = F.try_divide(F.col("_rr") - F.col("_r") * F.col("_r") / F.col("n"), (F.col("n") - 1).cast("double"))
    since_first = F.datediff(F.col("last_train_day"), F.col("_first")).cast("double")
    smoothed = F.lit(alpha) * F.col("_sw") + F.lit(1.0 - alpha) * F.pow(F.lit(1.0 - alpha), since_first) * F.col("_first_y")
    return packed.withColumns({
        "residual_std": F.sqrt(F.greatest(variance, F.lit(0.0))), "ses_level": smoothed,
    }).drop("_r", "_rr", "_sw", "_first", "_first_y")


def _additive(ts: str, cut: str) -> Column:
    d = F.to_date(F.col(ts))
    at = lambda m, k: F.coalesce(F.try_element_at(F.col(m), k), F.lit(0.0))
    return (
        F.col("intercept") + F.col("slope") * F.datediff(d, _cut(cut)).cast("double")
        + at("weekday_effect", C.weekday(d)) + at("month_effect", F.month(d))
        + F.when(C.eoq_window(d) == 1, F.col("eoq_effect")).otherwise(0.0)
        + F.when(C.is_holiday(d) == 1, F.col("holiday_effect")).otherwise(0.0)
        + F.when(C.weekday(d) >= 5, F.col("weekend_effect")).otherwise(0.0)
    )


def _predictions(ts: str, z: float) -> dict[str, tuple[Column, Column, Column]]:
    d = F.to_date(F.col(ts))
    none = F.lit(None).cast("double")
    additive = F.col("_additive")
    band = F.lit(z) * F.col("residual_std")
    ahead = F.datediff(d, F.col("last_train_day")).cast("double")
    return {
        "baseline": (F.try_element_at(F.col("weekday_mean"), C.weekday(d)), none, none),
        "additive": (additive, additive - band, additive + band),
        "naive": (F.col("last_value"), none, none),
        "ses": (F.col("ses_level"), none, none),
        "theta": (F.col("ses_level") + F.lit(0.5) * F.col("slope") * ahead, none, none),
    }


def targets(
    df: DataFrame, coef: DataFrame, target: str, cut: str, horizon: int = P.HORIZON, entity: str = P.ENTITY, ts: str = P.TS, salts: int = P.SALTS,
) -> DataFrame:
    """The rows to predict with their server's coefficients: test days, then the future days.

    A daily panel, whose servers the calendar bounds, needs one of the ``salts`` only.
    """
    test = df.filter(F.to_date(F.col(ts)) >= _cut(cut)).select(
        F.col(entity), F.to_date(F.col(ts)).alias(ts), F.col(target).cast("double").alias("actual"), F.lit(False).alias("is_future"),
    )
    test = attach_entity_stats(test, coef, [entity], ts, salts).filter(F.col("train_rows").isNotNull())
    days = F.sequence(F.date_add("last_day", 1), F.date_add("last_day", horizon), F.expr("INTERVAL 1 DAY"))
    ahead = coef.withColumn(ts, F.explode(days)).withColumns({
        "actual": F.lit(None).cast("double"), "is_future": F.lit(True),
    })
    return test.unionByName(ahead.select(test.columns))


def forecast_table(
    df: DataFrame, target: str, cut: str, horizon: int = P.HORIZON, models: Sequence[str] = MODELS,
    min_rows: int = P.MIN_HISTORY, alpha: float = P.SES_ALPHA, entity: str = P.ENTITY, ts: str = P.TS,
    coef: DataFrame | None = None, salts: int = P.SALTS,
) -> DataFrame:
    """Long forecast table of all models: test days with actuals and the future horizon."""
    if coef is None:
        # test days and future days both read it
        coef = stored(coefficients(cells(df, target, cut, alpha, entity, ts), cut, min_rows, alpha, entity), "coefficients")
    rows = targets(df, coef, target, cut, horizon, entity, ts, salts)
    if "additive" in models:
        rows = rows.withColumn("_additive", _additive(ts, cut))
    made = _predictions(ts, P.INTERVAL_Z80)
    each = F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), made[m][0].alias("predicted"), made[m][1].alias("yhat_lower"), made[m][2].alias("yhat_upper"))
        for m in models
    ]))
    return rows.withColumn("_p", each).select(
        entity, F.col("_p.model").alias("model"), ts, "actual", F.col("_p.predicted").alias("predicted"),
        F.col("_p.yhat_lower").alias("yhat_lower"), F.col("_p.yhat_upper").alias("yhat_upper"), "is_future",
    )


def forecast_quantiles(
    df: DataFrame, target: str, cut: str, horizon: int = P.HORIZON, probs: Sequence[float] = (0.1, 0.5, 0.9),
    entity: str = P.ENTITY, ts: str = P.TS,
) -> DataFrame:
    """Weekday-mean forecast plus the empirical quantiles of its training residuals per server."""
    from .quantiles import exact_quantiles, quantile_columns

    coef = coefficients(cells(df, target, cut, entity=entity, ts=ts), cut, entity=entity)
    means = coef.select(entity, "weekday_mean", "last_day")
    train = attach_entity_stats(df.filter(F.to_date(F.col(ts)) < _cut(cut)).select(entity, ts, target), means, [entity], ts)
    mean = F.try_element_at(F.col("weekday_mean"), C.weekday(ts))
    left = train.select(entity, (F.col(target) - mean).alias("_r"))
    names = {p: f"_q{i}" for i, p in enumerate(probs)}
    spread = quantile_columns(exact_quantiles(left, [entity], "_r", probs), [entity], names)
    days = F.sequence(F.date_add("last_day", 1), F.date_add("last_day", horizon), F.expr("INTERVAL 1 DAY"))
    ahead = means.join(spread, entity).withColumn(ts, F.explode(days))
    point = F.try_element_at(F.col("weekday_mean"), C.weekday(ts))
    return ahead.select(entity, ts, *[(point + F.col(names[p])).alias(f"p{round(p * 100):d}") for p in probs])


def stationarity(
    df: DataFrame, target: str, entity: str = P.ENTITY, ts: str = P.TS, regular: bool = False, critical: float = P.DF_CRITICAL_5PCT,
) -> DataFrame:
    """Dickey-Fuller regression of the change on the level before it, with a constant, per server."""
    held = df.filter(F.col(target).isNotNull()) if not regular else df
    moved = with_row_windows(held, [entity], ts, 1, lambda w: {"_before": F.lag(target, 1).over(w)}, regular)
    x, y = F.col("_before"), F.col(target) - F.col("_before")
    fit = moved.filter(x.isNotNull()).groupBy(entity).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_sxx(y, x).alias("sxx"), F.regr_syy(y, x).alias("syy"),
        F.regr_sxy(y, x).alias("sxy"), F.regr_count(y, x).alias("n"),
    )
    error = F.try_divide((F.col("syy") - F.col("slope") * F.col("sxy")), ((F.col("n") - 2) * F.col("sxx")))
    t = F.try_divide(F.col("slope"), F.sqrt(error))
    return fit.select(entity, F.col("n").alias("observations"), t.alias("df_statistic"), F.coalesce(t < critical, F.lit(False)).alias("is_stationary"))


# fixed values: response surface of the unit-root statistic with a constant (MacKinnon 1994): bounds, then
# coefficients by rising power below and above the turning point
_TAU_MIN, _TAU_TURN, _TAU_MAX = -18.83, -1.61, 2.74
_TAU_SMALL = (2.1659, 1.4412, 0.038269)
_TAU_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
# fixed values: rational approximation of the normal distribution (Abramowitz and Stegun 26.2.17)
_NORMAL = (0.2316419, (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429))


def _polynomial(coefficients: Sequence[float], x: Column) -> Column:
    total = F.lit(0.0)
    for c in reversed(coefficients):
        total = total * x + F.lit(c)
    return total


def normal_cdf(x: Column) -> Column:
    """Standard normal distribution function, to 7 digits."""
    slope, coefficients = _NORMAL
    k = F.lit(1.0) / (F.lit(1.0) + F.lit(slope) * F.abs(x))
    tail = F.exp(-x * x / 2) / F.lit(math.sqrt(2 * math.pi)) * k * _polynomial(coefficients, k)
    return F.when(x > 0, F.lit(1.0) - tail).otherwise(tail)


def unit_root_p_value(t: Column) -> Column:
    """Approximate p-value of a unit-root statistic of a regression with a constant."""
    z = F.when(t <= _TAU_TURN, _polynomial(_TAU_SMALL, t)).otherwise(_polynomial(_TAU_LARGE, t))
    return F.when(t > _TAU_MAX, 1.0).when(t < _TAU_MIN, 0.0).when(t.isNotNull(), normal_cdf(z))


def augmented_stationarity(
    df: DataFrame, target: str, lags: int = 5, choose: bool = True, entity: str = P.ENTITY, ts: str = P.TS, regular: bool = False, level: float = 0.05,
) -> DataFrame:
    """Augmented Dickey-Fuller test per server: change on the level before it, a constant and ``lags`` earlier changes.

    One pass sums each server's Gram matrix of these columns, partly before the shuffle. Sweeping it column
    by column then gives the regression with 0, 1, ... lags from the one before, all over the same rows; with
    ``choose`` the number of lags of least AIC is taken, else ``lags``. Missing values are left out. A server
    whose regression cannot be solved (too few rows, a constant series) has no statistic and is not stationary.
    """
    held = df if regular else df.filter(F.col(target).isNotNull())
    # the constant takes up the shift, which keeps the sums small
    centre = df.agg(F.avg(target).alias("_m")).select("_m").scalar()
    before = with_row_windows(held, [entity], ts, lags + 1, lambda w: {f"_l{i}": F.lag(target, i).over(w) for i in range(1, lags + 2)}, regular)
    at = [F.col(target).cast("double"), *[F.col(f"_l{i}").cast("double") for i in range(1, lags + 2)]]
    columns = [F.lit(1.0), at[1] - centre, *[at[i] - at[i + 1] for i in range(1, lags + 1)], at[0] - at[1]]
    last = len(columns) - 1
    rows = before.filter(at[0].isNotNull() & at[-1].isNotNull()).select(entity, *[c.alias(f"_x{i}") for i, c in enumerate(columns)])
    sums = {(i, j): F.sum(F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"_g{i}_{j}") for i in range(last + 1) for j in range(i, last + 1)}
    gram = rows.groupBy(entity).agg(F.count(F.lit(1)).alias("_n"), *sums.values())
    g = lambda i, j: F.col(f"_g{i}_{j}")
    gram = gram.withColumns({f"_g{j}_{i}": g(i, j) for i, j in sums if i < j} | {f"_d{i}": g(i, i) for i in range(last)})
    fits = []
    for k in range(last):
        pivot = F.when(g(k, k) > F.col(f"_d{k}") * F.lit(1e-10), g(k, k))
        swept = {f"_g{i}_{j}": g(i, j) - g(i, k) * g(k, j) / F.col("_p") for i in range(last + 1) for j in range(last + 1) if k not in (i, j)}
        swept |= {f"_g{k}_{j}": g(k, j) / F.col("_p") for j in range(last + 1) if j != k} | {f"_g{i}_{k}": -g(i, k) / F.col("_p") for i in range(last + 1) if i != k}
        gram = gram.withColumn("_p", pivot).withColumns(swept | {f"_g{k}_{k}": F.lit(1.0) / F.col("_p")})
        if k >= 1:
            used = k - 1
            free = F.col("_n") - F.lit(used + 2)
            squares = F.when((free > 0) & (g(last, last) > 0), g(last, last))
            aic = F.col("_n") * F.log(squares / F.col("_n")) + F.lit(2.0 * (used + 2))
            t = g(1, last) / F.sqrt(squares / free * g(1, 1))
            gram = gram.withColumn(f"_f{used}", F.struct(aic.alias("aic"), F.lit(used).alias("lags"), t.alias("t")))
            fits.append(F.col(f"_f{used}"))
    able = F.filter(F.array(*fits), lambda f: f["t"].isNotNull())
    best = F.array_min(able) if choose else F.get(F.filter(able, lambda f: f["lags"] == lags), 0)
    out = gram.withColumn("_best", best)
    t = F.col("_best.t")
    return out.select(
        entity, F.col("_n").alias("observations"), F.col("_best.lags").alias("lags"), t.alias("adf_statistic"), unit_root_p_value(t).alias("p_value"),
        F.coalesce(unit_root_p_value(t) < level, F.lit(False)).alias("is_stationary"),
    )


def rolling_origin(
    df: DataFrame, target: str, cuts: Sequence[str], horizon: int = P.HORIZON, min_rows: int = P.MIN_HISTORY,
    entity: str = P.ENTITY, ts: str = P.TS,
) -> DataFrame:
    """Weekday-mean forecasts from several origins: each fold trains before its cut and is scored on the horizon after it.

    Every row is reduced once, into the span between two cuts that it lies in; a fold's training sums are those
    of the spans before its cut. Only rows of a horizon are copied, so what is shuffled does not grow with the folds.
    """
    d = F.to_date(F.col(ts))
    order = sorted({str(c) for c in cuts})
    folds = F.array(*[F.struct(F.lit(i + 1).alias("fold"), _cut(c).alias("cut"), F.lit(order.index(str(c))).alias("upto")) for i, c in enumerate(cuts)])
    span = F.size(F.filter(F.array(*[_cut(c) for c in order]), lambda c: c <= d))
    sums = df.filter(d.isNotNull()).groupBy(entity, C.weekday(ts).alias("weekday"), span.alias("span")).agg(
        F.coalesce(F.sum(target), F.lit(0.0)).alias("s"), F.count(target).alias("n"), F.count(F.lit(1)).alias("rows"))
    # a server has at most seven weekdays in each span
    parts = sums.groupBy(entity).agg(F.collect_list(F.struct("span", "weekday", "s", "n", "rows")).alias("_parts")).withColumn("_f", F.explode(folds))
    before = parts.select(entity, "_f.fold", F.filter("_parts", lambda p: p["span"] <= F.col("_f.upto")).alias("_parts"))
    add = lambda xs, name, zero: F.aggregate(xs, zero, lambda a, p: a + p[name])

    def mean(w):
        own = F.filter("_parts", lambda p: p["weekday"] == w)
        return F.struct(w.alias("weekday"), F.try_divide(add(own, "s", F.lit(0.0)), add(own, "n", F.lit(0).cast("long")).cast("double")).alias("mean"))

    days = F.array_distinct(F.transform("_parts", lambda p: p["weekday"]))
    means = before.select(entity, "fold", add(F.col("_parts"), "rows", F.lit(0).cast("long")).alias("_rows"), F.map_from_entries(F.transform(days, mean)).alias("_means"))
    means = means.filter(F.col("_rows") >= min_rows)
    mine = F.filter(folds, lambda f: (f["cut"] <= F.col(ts)) & (F.col(ts) < F.date_add(f["cut"], horizon)))
    test = df.select(entity, d.alias(ts), F.col(target).alias("y")).select(entity, ts, "y", F.explode(mine).alias("_f")).select(entity, ts, "y", "_f.fold")
    scored = attach_entity_stats(test, means, [entity, "fold"], ts).filter(F.col("_rows").isNotNull())
    return scored.select(entity, "fold", ts, F.col("y").alias("actual"), F.try_element_at(F.col("_means"), C.weekday(ts)).alias("predicted"))


def forecast_custom_group(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str, columns: Sequence[str],
    entity: str = P.ENTITY, ts: str = P.TS,
) -> DataFrame:
    """Apply a user's per-server model: daily rows of one server in, forecast rows out.

    The input is averaged to one row per server and day first, so a call never sees more rows
    than the calendar has days, whatever the density of the readings.
    """
    daily = df.groupBy(entity, F.to_date(F.col(ts)).alias(ts)).agg(*[F.avg(c).alias(c) for c in columns])

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        return fn(rows.sort_values(ts, ignore_index=True))

    return daily.groupBy(entity).applyInPandas(run, schema)


# ---------------------------------------------------------------------------------------------
# Tree models on pyspark.ml: one model over all servers, which reach it through their own means.

TREE_FEATURES = (
    "is_eoq_window", "is_holiday", "is_weekend", "quarter", "month", "month_sin", "month_cos", "server_mean", "weekday_mean_y",
)


#: The features that differ from server to server, and where a fitted pipeline keeps their bins.
TREE_OWN = ("server_mean", "weekday_mean_y")
TREE_INPUTS = tuple(f"{c}_bin" if c in TREE_OWN else c for c in TREE_FEATURES)
#: Bins of a feature; the library cuts continuous features into as many.
TREE_BINS = 32


def tree_stats(df: DataFrame, target: str, cut: str, entity: str = P.ENTITY, ts: str = P.TS) -> DataFrame:
    """What the tree models know of a server: one stored row, for training and for scoring."""
    cell = cells(df, target, cut, entity=entity, ts=ts)
    coef = coefficients(cell, cut, entity=entity).select(entity, "train_rows", "last_day", "weekday_mean")
    own = cell.filter("train").groupBy(entity).agg((F.sum("sy") / F.sum("n")).alias("server_mean"))
    return stored(coef.join(own, entity), "tree-stats")


def tree_training(
    df: DataFrame, target: str, cut: str, entity: str = P.ENTITY, ts: str = P.TS, stats: DataFrame | None = None,
) -> DataFrame:
    """Training table of the tree models: one weighted row per cell instead of one per day.

    All days of a cell have the same features, so their mean with their count as weight gives the
    same splits and leaves while the table stays small however long the history is.
    """
    stats = tree_stats(df, target, cut, entity, ts) if stats is None else stats
    rows = cells(df, target, cut, entity=entity, ts=ts).filter("train AND n > 0").join(stats, entity)
    angle = F.lit(2 * math.pi) * F.col("month") / F.lit(12)
    return rows.select(
        entity, (F.col("sy") / F.col("n")).alias("label"), F.col("n").cast("double").alias("weight"),
        F.col("eoq").alias("is_eoq_window"), F.col("holiday").alias("is_holiday"), F.when(F.col("weekday") >= 5, 1).otherwise(0).alias("is_weekend"),
        F.ceil(F.col("month") / F.lit(3)).cast("int").alias("quarter"), "month", F.sin(angle).alias("month_sin"), F.cos(angle).alias("month_cos"),
        "server_mean", F.coalesce(F.try_element_at(F.col("weekday_mean"), F.col("weekday")), F.col("server_mean")).alias("weekday_mean_y"),
    )


def tree_rows(
    df: DataFrame, target: str, cut: str, horizon: int = P.HORIZON, entity: str = P.ENTITY, ts: str = P.TS,
    stats: DataFrame | None = None, salts: int = P.SALTS,
) -> DataFrame:
    """Calendar features plus the server's training mean and weekday mean for test and future rows."""
    stats = tree_stats(df, target, cut, entity, ts) if stats is None else stats
    seen = df.filter(F.to_date(F.col(ts)) >= _cut(cut)).select(entity, F.to_date(F.col(ts)).alias(ts), F.col(target).cast("double").alias("label"))
    seen = attach_entity_stats(seen, stats, [entity], ts, salts).filter(F.col("train_rows").isNotNull()).withColumn("part", F.lit("test"))
    days = F.sequence(F.date_add("last_day", 1), F.date_add("last_day", horizon), F.expr("INTERVAL 1 DAY"))
    ahead = stats.withColumn(ts, F.explode(days)).withColumns({"label": F.lit(None).cast("double"), "part": F.lit("future")})
    rows = seen.unionByName(ahead.select(seen.columns))
    made = C.future_regressors(ts) | {"weekday_mean_y": F.coalesce(F.try_element_at(F.col("weekday_mean"), C.weekday(ts)), F.col("server_mean"))}
    return rows.withColumns(made).select(entity, ts, "label", "part", *TREE_FEATURES)


def tree_bins(train: DataFrame):
    """The first stage of the pipeline: bins between quantiles of the servers' own features, over all training rows."""
    from pyspark.ml.feature import Bucketizer

    probs = [i / TREE_BINS for i in range(1, TREE_BINS)]
    cuts = train.agg(*[F.array_sort(F.array_distinct(F.percentile_approx(c, probs, 10_000))).alias(c) for c in TREE_OWN]).first()
    edges = [[-math.inf, *(cuts[c] or [0.0]), math.inf] for c in TREE_OWN]
    return Bucketizer(splitsArray=edges, inputCols=list(TREE_OWN), outputCols=[f"{c}_bin" for c in TREE_OWN])


def merged_training(train: DataFrame, bins) -> DataFrame:
    """Training rows of equal features after binning as one weighted row.

    Trees see bins only, so the weighted mean of such rows takes part in splits and leaves as the rows did; the
    forest draws its samples, and counts the rows of a leaf, among them. The table is bounded by bins and
    calendar, however many servers there are.
    """
    # the least value of a bin stands for it: it is in the bin again when the pipeline looks
    return bins.transform(train).groupBy(*TREE_INPUTS).agg(
        (F.sum(F.col("weight") * F.col("label")) / F.sum("weight")).alias("label"), F.sum("weight").alias("weight"),
        *[F.min(c).alias(c) for c in TREE_OWN],
    ).drop(*[f"{c}_bin" for c in TREE_OWN])


def fit_trees(train: DataFrame, kind: str = "random_forest", trees: int = 150, depth: int | None = None):
    """The fitted pipeline of ``tree_model``; ``train`` must be a stored table."""
    bins = tree_bins(train)
    merged = stored(merged_training(train, bins), "tree-merged")
    return tree_model(kind, trees, depth, bins=bins).fit(merged)


def tree_model(kind: str = "random_forest", trees: int = 150, depth: int | None = None, rate: float = 0.05, seed: int = 42, bins=None):
    """An unfitted pyspark.ml pipeline: ``random_forest`` (depth 12) or ``gradient_boost`` (depth 6).

    With ``bins`` (``tree_bins``) the servers' own features are binned by it, else by the trees themselves.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor, RandomForestRegressor

    shape = dict(featuresCol="features", labelCol="label", weightCol="weight", predictionCol="predicted", seed=seed, maxMemoryInMB=256)
    if kind == "random_forest":
        # rows keep their nodes' numbers, so that no level sends the trees grown so far from the driver
        model = RandomForestRegressor(numTrees=trees, maxDepth=depth or 12, minInstancesPerNode=2, featureSubsetStrategy="all", cacheNodeIds=True, **shape)
    else:
        model = GBTRegressor(maxIter=trees, maxDepth=depth or 6, stepSize=rate, **shape)
    inputs = TREE_FEATURES if bins is None else TREE_INPUTS
    return Pipeline(stages=[*([] if bins is None else [bins]), VectorAssembler(inputCols=list(inputs), outputCol="features"), model])


#: So many rows of different features are scored and sent to every executor at most.
TREE_KINDS = 250_000


def score_model(model, rows: DataFrame, name: str, entity: str = P.ENTITY, ts: str = P.TS) -> DataFrame:
    """Forecast rows of a fitted tree model for the test and future parts.

    Where the pipeline bins its features, many rows are alike to the trees: each kind is scored once, and the
    rows take their kind's prediction.
    """
    from pyspark.ml.feature import Bucketizer

    first = model.stages[0]
    out = None
    if isinstance(first, Bucketizer):
        placed = stored(first.transform(rows), "tree-rows")
        kinds = stored(placed.groupBy(*TREE_INPUTS).agg(*[F.min(c).alias(c) for c in TREE_OWN]), "tree-kinds")
        if kinds.count() <= TREE_KINDS:
            scored = kinds
            for stage in model.stages[1:]:
                scored = stage.transform(scored)
            out = placed.join(F.broadcast(stored(scored.select(*TREE_INPUTS, "predicted"), "tree-scores")), list(TREE_INPUTS), "left")
    out = model.transform(rows) if out is None else out
    none = F.lit(None).cast("double")
    return out.select(
        entity, F.lit(name).alias("model"), ts, F.col("label").alias("actual"), "predicted", none.alias("yhat_lower"),
        none.alias("yhat_upper"), (F.col("part") == "future").alias("is_future"),
    )


def feature_importance(spark, model) -> DataFrame:
    """Importance per feature of a fitted tree pipeline."""
    weights = model.stages[-1].featureImportances
    rows = [(n, float(weights[i])) for i, n in enumerate(TREE_FEATURES)]
    return spark.createDataFrame(rows, "feature string, importance double")


def save_coefficients(coef: DataFrame, path: str) -> None:
    coef.write.mode("overwrite").parquet(path)


def load_coefficients(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)
