"""Numeric expressions (B3, B4, B16-B22, B24) and order-independent sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

# Sensors report one or two decimals. More decimals change no result, only how a mean is summed.
DECIMALS = 4
# Whole numbers up to here are exact in a double.
WHOLE = float(2**53)


def to_double(text: Column) -> Column:
    """Text -> double; what is not a number becomes NULL."""
    number = F.trim(text).try_cast("double")
    suffixed = F.trim(text).rlike("[dDfF]$")
    return F.when(~suffixed & ~F.isnan(number), number)


def clamp_floor(value: Column, floor: float = 0.0) -> Column:
    """Values below the floor become the floor; NULL stays NULL."""
    return F.when(value < floor, F.lit(floor)).otherwise(value)


def scaled(value: Column, decimals: int = DECIMALS) -> Column:
    """The value as a whole number of 10^-decimals, NULL where it is none: more decimals, too large, NaN."""
    scale = F.lit(float(10**decimals))
    whole = F.rint(value * scale)
    return F.when((F.abs(whole) <= WHOLE) & (whole / scale == value), whole.cast("bigint"))


def mean_of_parts(total: Column, fitting: Column, plain: Column, count: Column, decimals: int = DECIMALS) -> Column:
    """A mean from a sum of `scaled` values, if all `count` of them fit, or else from the plain sum."""
    exact = F.when(fitting == count, total / F.lit(float(10**decimals)))
    return F.try_divide(F.coalesce(exact, plain), count)


def exact_mean(value: Column, decimals: int = DECIMALS, over: WindowSpec | None = None) -> Column:
    """The mean of the non-NULL values; NULL for an empty group.

    Where every value of the group has at most so many decimals, it is summed over bigint, the same
    whatever the order of partial sums or a retried task. Other groups have the plain mean of doubles.
    """
    whole = scaled(value, decimals)
    parts = [F.try_sum(whole), F.count(whole), F.sum(value.cast("double")), F.count(value)]
    return mean_of_parts(*(part if over is None else part.over(over) for part in parts), decimals)


def portable_round(value: Column, digits: int, mode: str = "half_up") -> Column:
    """Round a double without depending on how its decimal text ends.

    `half_up` goes through a decimal, `half_even` scales, rounds and unscales as numpy does.
    """
    if mode == "half_even":
        scale = F.lit(float(10**digits))
        return F.rint(value * scale) / scale
    if mode != "half_up":
        raise ValueError(f"unknown rounding mode {mode!r}")
    return F.round(value.cast("decimal(28,10)"), digits).cast("double")


def exceeds(value: Column, threshold: float) -> Column:
    """1 above the threshold, 0 at or below it, NULL where the value is missing."""
    return (value > F.lit(threshold)).cast("int")


def exceeds_for(code: Column, wanted: str, value: Column, threshold: float) -> Column:
    """The flag for one code only, NULL for every other code."""
    return F.when(code == wanted, exceeds(value, threshold))


def classes_left_closed(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """[.., e1), [e1, e2), ..; the last label takes the rest, NULL included."""
    if len(labels) != len(edges) + 1:
        raise ValueError("one label more than edges is needed")
    result = F.when(value < edges[0], labels[0])
    for edge, label in zip(edges[1:], labels[1:-1]):
        result = result.when(value < edge, label)
    return result.otherwise(labels[-1])


def classes_right_closed(value: Column, bins: Sequence[float], labels: Sequence[str]) -> Column:
    """(b0, b1], (b1, b2], ..; outside is NULL."""
    if len(labels) != len(bins) - 1:
        raise ValueError("one label per interval is needed")
    result = F.when(value <= bins[0], F.lit(None).cast("string"))
    for edge, label in zip(bins[1:], labels):
        result = result.when(value <= edge, label)
    return result


def safe_ratio(top: Column, bottom: Column) -> Column:
    """NULL where the divisor is zero or missing."""
    return F.try_divide(top, bottom)


def either_flag(*flags: Column) -> Column:
    """1 where the flags add up to more than 0; a missing flag makes the answer 0."""
    total = flags[0]
    for flag in flags[1:]:
        total = total + flag
    return F.coalesce(total > 0, F.lit(False)).cast("int")


def alert_label(forecast: Column, threshold: Column | float, digits: int | None = None) -> Column:
    """B24: 'ALERT' or '-'; `digits` compares the rounded forecast, as a published table does."""
    shown = forecast if digits is None else portable_round(forecast, digits, "half_even")
    return F.when(shown > threshold, "ALERT").otherwise("-")
