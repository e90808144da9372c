"""Registered queries on the given tables."""

from sensorloom.catalog import cleaning, files, forecasting, series, warehouse  # noqa: F401
from sensorloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
