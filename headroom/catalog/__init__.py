"""Registered queries, each next to the SQL that must give the same rows."""

from .base import ORACLES, QUERIES
from . import aggregates, cleaning, combining, features, files, forecasts, risks, scalars, validation  # noqa: F401  isort:skip

__all__ = ["ORACLES", "QUERIES"]
