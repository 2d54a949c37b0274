"""Forecast errors and model choice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P

_EPS = 2.220446049250313e-16


def scored(df: DataFrame) -> DataFrame:
    """Rows that have both an actual and a prediction."""
    return df.filter(F.col("actual").isNotNull() & F.col("predicted").isNotNull())


def _gap() -> Column:
    return F.abs(F.col("actual") - F.col("predicted"))


def _both() -> Column:
    return F.abs("actual") + F.abs("predicted")


def error_metrics(df: DataFrame, keys: Sequence[str] = (P.ENTITY, "model"), digits: bool = True) -> DataFrame:
    """MAE, RMSE and sMAPE in percent; a pair of zeros counts as no error."""
    share = F.when(_both() > 1e-8, _gap() / _both()).otherwise(0.0)
    mae, rmse, smape = F.avg(_gap()), F.sqrt(F.avg(_gap() * _gap())), F.avg(share) * 200
    if digits:
        mae, rmse, smape = F.round(mae, 4), F.round(rmse, 4), F.round(smape, 2)
    return scored(df).groupBy(*keys).agg(mae.alias("mae"), rmse.alias("rmse"), smape.alias("smape"))


def smape_skip_zero(df: DataFrame, keys: Sequence[str] = (P.ENTITY, "model")) -> DataFrame:
    """sMAPE that skips pairs of zeros, with MAE and RMSE, unrounded."""
    share = F.try_divide(2 * _gap(), _both())
    return scored(df).groupBy(*keys).agg(
        (F.avg(share) * 100).alias("smape"), F.avg(_gap()).alias("mae"), F.sqrt(F.avg(_gap() * _gap())).alias("rmse"))


def mape_eps(df: DataFrame, keys: Sequence[str] = (P.ENTITY, "model")) -> DataFrame:
    """MAE, RMSE and MAPE with the denominator floored at the machine epsilon."""
    share = _gap() / F.greatest(F.abs("actual"), F.lit(_EPS))
    return scored(df).groupBy(*keys).agg(
        F.avg(_gap()).alias("mae"), F.sqrt(F.avg(_gap() * _gap())).alias("rmse"), F.avg(share).alias("mape"))


def mape_additive_eps(df: DataFrame, keys: Sequence[str] = (P.ENTITY, "model")) -> DataFrame:
    """Mean absolute percentage error with 1e-6 added to the actual value."""
    share = F.abs(F.try_divide(F.col("actual") - F.col("predicted"), F.col("actual") + 1e-6))
    return scored(df).groupBy(*keys).agg((F.avg(share) * 100).alias("mape"))


def compare_models(df: DataFrame) -> DataFrame:
    """One row of errors per model over all servers."""
    return error_metrics(df, ["model"], digits=False)


def best_model(metrics: DataFrame) -> DataFrame:
    """The model with the lowest mean sMAPE; ties go to the first name."""
    means = metrics.groupBy("model").agg(F.avg("smape").alias("avg_smape"))
    pick = F.min(F.struct("avg_smape", "model")).alias("_b")
    return means.agg(pick, F.count(F.lit(1)).alias("models")).select(
        F.col("_b.model").alias("best_model"), F.col("_b.avg_smape").alias("avg_smape"), "models")


def improvement_over_baseline(metrics: DataFrame, baseline: str = "baseline", score: str = "mae") -> DataFrame:
    """Relative gain in percent of each model's mean score over the baseline's."""
    means = metrics.groupBy("model").agg(F.avg(score).alias("_m"))
    base = means.filter(F.col("model") == baseline).select("_m").scalar()
    return means.select("model", F.col("_m").alias("score"), (F.try_divide(base - F.col("_m"), base) * 100).alias("improvement_pct"))


def forecast_drift(new: DataFrame, old: DataFrame, keys: Sequence[str] = (P.ENTITY, P.TS)) -> DataFrame:
    """Mean absolute difference per server between two versions, and rows only one of them has."""
    a = new.select(*keys, F.col("predicted").alias("_new"), F.lit(1).alias("_in_new"))
    b = old.select(*keys, F.col("predicted").alias("_old"), F.lit(1).alias("_in_old"))
    both = a.join(b, list(keys), "full")
    return both.groupBy(keys[0]).agg(
        F.avg(F.abs(F.col("_new") - F.col("_old"))).alias("mean_abs_change"),
        F.count_if(F.col("_in_old").isNull()).alias("only_new"), F.count_if(F.col("_in_new").isNull()).alias("only_old"),
    )
