"""Scalar expressions on metric columns."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c: Column | str) -> Column:
    """NaN and both infinities become NULL, the only missing marker used by the operators."""
    c = col(c)
    bad = F.isnan(c) | (c == F.lit(math.inf)) | (c == F.lit(-math.inf))
    return F.when(~bad, c)


def clip(c: Column | str, lo: float, hi: float) -> Column:
    """Clamp to ``[lo, hi]``; NULL stays NULL."""
    c = col(c)
    return F.when(c.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), c)))


def drop_incomplete(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Turn non-finite doubles into NULL and drop rows with any NULL in ``columns``."""
    columns = columns or df.columns
    doubles = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    out = df.withColumns({c: finite(c) for c in columns if c in doubles})
    return out.na.drop("any", subset=columns)


def flag(condition: Column) -> Column:
    """A predicate as 0/1 with NULL counted as 0."""
    return F.when(condition, 1).otherwise(0)


def truth(condition: Column) -> Column:
    """A predicate as boolean with NULL counted as false."""
    return F.coalesce(condition, F.lit(False))


def level(c: Column | str, cuts: list[tuple[float, str]], default: str) -> Column:
    """Label of the first cut (given from high to low) the value lies strictly above."""
    out = None
    for bound, label in cuts:
        cond = col(c) > F.lit(bound)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(default)


def padded_id(n: Column | str, prefix: str = "SRV-", width: int = 4) -> Column:
    return F.format_string(f"{prefix}%0{width}d", col(n))


def columns_of_type(df: DataFrame, exclude: tuple[str, ...] = (), contains: str | None = None) -> list[str]:
    """Names of the numeric columns, less ``exclude``, optionally only names holding ``contains``."""
    names = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]
    return [n for n in names if contains is None or contains in n]


def rounded(df: DataFrame, digits: int = 6, columns: list[str] | None = None) -> DataFrame:
    """Round the double columns."""
    names = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    names = [n for n in names if columns is None or n in columns]
    return df.withColumns({n: F.round(F.col(n), digits) for n in names}) if names else df
