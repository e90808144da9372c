"""The registered queries: a Spark job each, with its SQL twin where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query under a name, with the SQL its result must equal."""

    def add(build: Build) -> Build:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def half_up(expression: str, digits: int) -> str:
    """SQL of `portable_round`."""
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def half_even(expression: str, digits: int) -> str:
    """SQL of `portable_round` in its half-even mode."""
    scale = float(10**digits)
    return f"(round_even(({expression}) * {scale}, 0) / {scale})"


def exact_sum(expression: str) -> str:
    """SQL of `exact_sum` for values of two decimals."""
    return f"CAST(SUM(CAST({expression} AS DECIMAL(18,2))) AS DOUBLE)"


def exact_mean(expression: str) -> str:
    """SQL of `exact_mean` for values of two decimals."""
    return f"({exact_sum(expression)} / COUNT({expression}))"
