"""Inputs several registered queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.sizing import stored, stored_by
from ..operators import clean, forecast
from ..operators.segments import BUILT
from ..sources import panels
from .base import CUT


def cpu_panel(spark: SparkSession, folder: str) -> DataFrame:
    """Gap-free interpolated CPU series, stored because models read it more than once; a server has a row a day."""
    daily = panels.supplier_spine(spark, folder).select("server_id", "timestamp", "cpu_p95")
    return stored_by(clean.interpolate_linear(daily, ["cpu_p95"], regular=BUILT), "server_id", "panel")


def forecasts(spark: SparkSession, folder: str, models=("baseline", "additive"), panel: DataFrame | None = None, coef: DataFrame | None = None) -> DataFrame:
    """The forecast table of a panel; queries that need the panel or its coefficients twice give them."""
    panel = cpu_panel(spark, folder) if panel is None else panel
    return forecast.forecast_table(panel, "cpu_p95", CUT, models=models, coef=coef, salts=1)


def panel_coefficients(panel: DataFrame) -> DataFrame:
    return stored(forecast.coefficients(forecast.cells(panel, "cpu_p95", CUT), CUT), "coefficients")
