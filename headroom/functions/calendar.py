"""Calendar expressions. All are plain column expressions, so they need no join and no state."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params as P
from .numeric import col, flag


def day(ts: Column | str) -> Column:
    return F.to_date(col(ts))


def weekday(ts: Column | str) -> Column:
    """Monday is 0."""
    return F.weekday(day(ts))


def is_weekend(ts: Column | str) -> Column:
    return flag(weekday(ts) >= 5)


def is_quarter_end(ts: Column | str) -> Column:
    """1 on the last day of March, June, September and December."""
    d = day(ts)
    return flag((F.month(d) % 3 == 0) & (d == F.last_day(d)))


def eoq_window(
    ts: Column | str,
    days: int = P.EOQ_DAYS,
    months: tuple[int, ...] = P.EOQ_MONTHS,
    variant: str = "month_end",
) -> Column:
    """1 in the last ``days`` days of a quarter-end month.

    ``variant='fixed31'`` treats every month as 31 days long, so 30-day months get a day less.
    """
    d = day(ts)
    length = F.lit(31) if variant == "fixed31" else F.dayofmonth(F.last_day(d))
    return flag(F.month(d).isin(*months) & (F.dayofmonth(d) >= length - days + 1))


# fixed values: US federal holidays as month * 100 + day, on fixed dates and on the k-th or last weekday
_FIXED = (101, 704, 1111, 1225)
_MONDAYS = ((115, 121), (215, 221), (525, 531), (901, 907), (1008, 1014))
_THURSDAYS = ((1122, 1128),)
# the weekdays that stand in for a fixed date on a weekend: Friday before, Monday after
_FRIDAY_BEFORE = (1231, 703, 1110, 1224)
_MONDAY_AFTER = (102, 705, 1112, 1226)
_JUNE_SINCE, _JUNE_DAY = 2021, 619


def is_holiday(ts: Column | str) -> Column:
    """1 on US federal holidays and on the weekday a weekend holiday is observed on.

    Set membership of one small number keeps the generated code short.
    """
    d = day(ts)
    at, w = F.month(d) * 100 + F.dayofmonth(d), F.weekday(d)
    days = lambda spans: [n for lo, hi in spans for n in range(lo, hi + 1)]
    june = (at == _JUNE_DAY) | ((w == 4) & (at == _JUNE_DAY - 1)) | ((w == 0) & (at == _JUNE_DAY + 1))
    return flag(
        at.isin(*_FIXED) | ((w == 0) & at.isin(*days(_MONDAYS), *_MONDAY_AFTER)) | ((w == 3) & at.isin(*days(_THURSDAYS)))
        | ((w == 4) & at.isin(*_FRIDAY_BEFORE)) | ((F.year(d) >= _JUNE_SINCE) & june)
    )


def cyclic_month(ts: Column | str) -> tuple[Column, Column]:
    angle = F.lit(2 * math.pi) * F.month(day(ts)) / F.lit(12)
    return F.sin(angle), F.cos(angle)


def calendar_parts(ts: Column | str) -> dict[str, Column]:
    d = day(ts)
    return {
        "year": F.year(d),
        "month": F.month(d),
        "quarter": F.quarter(d),
        "dayofweek": weekday(d),
        "dayofyear": F.dayofyear(d),
        "is_weekend": is_weekend(d),
    }


def calendar_features(df: DataFrame, ts: str = P.TS, holidays: bool = True) -> DataFrame:
    """Year, month, quarter, weekday, weekend, quarter end and holiday of a date column."""
    parts = calendar_parts(ts)
    parts.pop("dayofyear")
    parts["is_eoq"] = is_quarter_end(ts)
    if holidays:
        parts["is_holiday"] = is_holiday(ts)
    return df.withColumns(parts)


def future_regressors(ts: Column | str, holiday_mode: str = "calendar", eoq_mode: str = "window") -> dict[str, Column]:
    """Calendar regressors of future dates.

    ``holiday_mode='zero'`` sets holidays to 0; ``eoq_mode='quarter_end'`` flags only the last day.
    """
    sin, cos = cyclic_month(ts)
    return {
        "is_eoq_window": eoq_window(ts) if eoq_mode == "window" else is_quarter_end(ts),
        "is_holiday": is_holiday(ts) if holiday_mode == "calendar" else F.lit(0),
        "is_weekend": is_weekend(ts),
        "quarter": F.quarter(day(ts)),
        "month": F.month(day(ts)),
        "month_sin": sin,
        "month_cos": cos,
    }


def date_axis(spark: SparkSession, start: Column, end: Column, step: str = "1 day") -> DataFrame:
    """One row per step from ``start`` to ``end`` (columns may be scalar subqueries)."""
    axis = F.explode(F.sequence(start, end, F.expr(f"INTERVAL {step}")))
    return spark.range(1).select(axis.alias(P.TS))


def holiday_calendar(spark: SparkSession, start: Column, end: Column) -> DataFrame:
    """The holidays between two dates, one row each: at most fifteen rows per year."""
    return date_axis(spark, start, end).filter(is_holiday(P.TS) == 1)


def period_distance(ts: Column | str) -> dict[str, Column]:
    """Days to the quarter end, month-end flag and business-hour flag (9 to 17 inclusive)."""
    d = day(ts)
    quarter_end = F.last_day(F.add_months(F.trunc(d, "quarter"), 2))
    return {
        "days_to_quarter_end": F.datediff(quarter_end, d),
        "is_month_end": flag(d == F.last_day(d)),
        "is_business_hour": flag(F.hour(col(ts)).between(9, 17)),
    }


def quarter_ramp_factor(ts: Column | str) -> Column:
    """1.06 rising to 1.30 over the last five days of a quarter, else 1."""
    d = day(ts)
    left = F.datediff(F.last_day(d), d)
    return F.when((F.month(d) % 3 == 0) & (left <= 4), 1.0 + F.lit(0.3) * (5 - left) / F.lit(5)).otherwise(1.0)


def holiday_load_factor(ts: Column | str) -> Column:
    """Load multiplier around holidays; the first matching rule wins."""
    d = day(ts)
    m, n = F.month(d), F.dayofmonth(d)
    # fixed values: (rule, factor) in the order they are tried
    return (
        F.when((m == 1) & (n == 1), 0.5)
        .when((m == 12) & (n >= 25), 0.6)
        .when((m == 7) & (n == 4), 0.7)
        .when((m == 11) & n.between(22, 28), 0.7)
        .when((m == 12) & (n == 24), 0.7)
        .otherwise(1.0)
    )


def seasonal_expectation(
    ts: Column | str,
    first: Column,
    last: Column,
    weekend_factor: float = 0.8,
    amplitude: float = 0.15,
    growth: float = 0.2,
    eoq_factor: float = 1.25,
    holiday_factor: float = 0.7,
) -> Column:
    """Deterministic multiplicative profile: weekday, year wave, growth, quarter end, holiday."""
    d = day(ts)
    wave = 1 + F.lit(amplitude) * F.sin(F.lit(2 * math.pi) * F.dayofyear(d) / F.lit(365.25))
    trend = 1 + F.lit(growth) * F.coalesce(F.try_divide(F.datediff(d, first), F.datediff(last, first)), F.lit(0.0))
    weekly = F.when(weekday(d) >= 5, weekend_factor).otherwise(1.0)
    eoq = F.when(eoq_window(d, variant="fixed31") == 1, eoq_factor).otherwise(1.0)
    hol = F.when(is_holiday(d) == 1, holiday_factor).otherwise(1.0)
    return weekly * wave * trend * eoq * hol
