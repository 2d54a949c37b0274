"""Operators of a training-data pipeline over text and vectors; nothing else in the library imports them."""

from .queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
