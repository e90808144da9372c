"""Forecast metrics and thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom import settings
from sensorloom.functions.numeric import alert_label, portable_round


def _ratio(top: Column, bottom: Column) -> Column:
    """A share that is 0 where there is nothing to share."""
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def metrics(
    df: DataFrame,
    model: str,
    actual: str,
    forecast: str,
    threshold: float = settings.GUIDELINE,
    alert_above: Column | float | None = None,
    keys: Sequence[str] = (),
    digits: int = 6,
) -> DataFrame:
    """L4: error and exceedance metrics in one aggregate."""
    y, f = F.col(actual), F.col(forecast)
    real, alert = y > threshold, f > (threshold if alert_above is None else alert_above)
    hits, reals, alerts = F.count_if(real & alert), F.count_if(real), F.count_if(alert)
    spread = F.var_pop(y) * F.count(y)
    summary = df.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.avg(F.abs(y - f)).alias("MAE"),
        F.sqrt(F.avg((y - f) * (y - f))).alias("RMSE"),
        (F.lit(1.0) - F.try_divide(F.sum((y - f) * (y - f)), spread)).alias("R2"),
        _ratio(hits, reals).alias("recall"),
        _ratio(hits, alerts).alias("precision"),
        _ratio(F.lit(2.0) * hits, reals + alerts).alias("F1"),
    )
    shown = [portable_round(F.col(name), digits).alias(name) for name in ("MAE", "RMSE", "R2", "recall", "precision", "F1")]
    return summary.select(F.lit(model).alias("model"), *keys, "n", *shown)


def threshold_curve(
    df: DataFrame,
    actual: str,
    forecast: str,
    thresholds: Sequence[float] = tuple(settings.THRESHOLDS),
    guideline: float = settings.GUIDELINE,
    digits: int = 6,
) -> DataFrame:
    """Recall, precision and F1 per alert threshold.

    One pass with a counter per threshold; the rows are never multiplied by the thresholds.
    """
    real, f = F.col(actual) > guideline, F.col(forecast)
    counts = df.agg(
        F.count_if(real).alias("reals"),
        *[F.count_if(f > t).alias(f"alerts{i}") for i, t in enumerate(thresholds)],
        *[F.count_if(real & (f > t)).alias(f"hits{i}") for i, t in enumerate(thresholds)],
    )
    entries = [
        F.struct(
            F.lit(float(t)).alias("threshold"),
            portable_round(_ratio(F.col(f"hits{i}"), F.col("reals")), digits).alias("recall"),
            portable_round(_ratio(F.col(f"hits{i}"), F.col(f"alerts{i}")), digits).alias("precision"),
            portable_round(
                _ratio(F.lit(2.0) * F.col(f"hits{i}"), F.col("reals") + F.col(f"alerts{i}")), digits
            ).alias("F1"),
        )
        for i, t in enumerate(thresholds)
    ]
    return counts.select(F.inline(F.array(*entries)))


def choose_threshold(curve: DataFrame, min_recall: float = settings.MIN_RECALL) -> DataFrame:
    """The highest threshold with enough recall; NULL if none has."""
    return curve.agg(
        F.max(F.when(F.col("recall") >= min_recall, F.col("threshold"))).alias("alert_threshold")
    )


def confusion(
    df: DataFrame,
    actual: str,
    forecast: str,
    guideline: float = settings.GUIDELINE,
    alert_above: Column | float | None = None,
) -> DataFrame:
    """The four counts, zeros included."""
    real = F.col(actual) > guideline
    alert = F.col(forecast) > (guideline if alert_above is None else alert_above)
    cells = [(0, 0, ~real & ~alert), (0, 1, ~real & alert), (1, 0, real & ~alert), (1, 1, real & alert)]
    counts = df.agg(*[F.count_if(hit).alias(f"c{a}{b}") for a, b, hit in cells])
    entries = [
        F.struct(F.lit(a).alias("actual_above"), F.lit(b).alias("alert"), F.col(f"c{a}{b}").alias("n"))
        for a, b, _ in cells
    ]
    return counts.select(F.inline(F.array(*entries)))


def published(
    df: DataFrame,
    today: str,
    actual: str,
    forecast: str,
    alert_above: Column | float,
    digits: int = 1,
) -> DataFrame:
    """The forecasts as published, by the day they are for; alerts use the rounded forecast."""
    return df.select(
        F.col("date").alias("day"),
        F.date_add("date", 1).alias("forecast_day"),
        F.col(today).alias("measured_today"),
        F.col(actual).alias("measured_next_day"),
        portable_round(F.col(forecast), digits, "half_even").alias("forecast"),
        alert_label(F.col(forecast), alert_above, digits).alias("alert"),
    )
