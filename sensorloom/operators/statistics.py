"""Counts, correlations, probabilities and quantiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.functions.numeric import exact_mean, portable_round
from sensorloom.session import stored

# Of the sketches behind exact quantiles: their ranks are right to one part in so many.
ACCURACY = 100_000


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value."""
    return df.groupBy(column).agg(F.count("*").alias("n_rows"))


def crosstab(df: DataFrame, row: Column, row_name: str, code: str, codes: Sequence[str]) -> DataFrame:
    """Rows per row value and code, 0 where there is none."""
    return df.groupBy(row.alias(row_name)).agg(
        *[F.count_if(F.col(code) == value).alias(value) for value in codes]
    )


def profile(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Rows and time range per group."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("n_rows"),
        F.min(time).alias("first_value"),
        F.max(time).alias("latest_value"),
    )


def correlations(df: DataFrame, variables: Sequence[str], target: str, digits: int = 6) -> DataFrame:
    """Pearson correlation of each variable with the target, in one pass.

    A row counts for a variable where both values are present.
    """
    row = df.agg(*[F.corr(name, target).alias(name) for name in variables])
    pairs = F.array(*[F.struct(F.lit(name).alias("variable"), F.col(name).alias("r")) for name in variables])
    long = row.select(F.explode(pairs).alias("pair"))
    return long.select(
        "pair.variable", portable_round(F.col("pair.r"), digits).alias("correlation")
    )


def exceedance_memory(df: DataFrame, today: str, tomorrow: str, threshold: float, digits: int = 6) -> DataFrame:
    """How often tomorrow is above, given today above and given today not above, and their correlation `r`."""
    pairs = df.filter(F.col(today).isNotNull() & F.col(tomorrow).isNotNull())
    above, next_above = F.col(today) > threshold, F.col(tomorrow) > threshold

    def share(condition):
        return F.try_divide(F.count_if(condition & next_above), F.count_if(condition))

    return pairs.agg(
        F.count("*").alias("pairs"),
        share(above).alias("p_above_after_above"),
        share(~above).alias("p_above_after_below"),
        portable_round(F.corr(today, tomorrow), digits).alias("r"),
    )


def brackets(measured: DataFrame, keys: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """Per group its size `_n`, and for every share two values that the wanted ranks lie between.

    A quantile sketch per group, combined on the map side, is right to 1 / ACCURACY of the ranks; values
    are taken three times as far off. A group of up to ACCURACY rows is its own bracket.
    """
    margin = 3 / ACCURACY
    low, high = [max(0.0, s - margin) for s in shares], [min(1.0, s + margin) for s in shares]
    sketch = measured.groupBy(*keys).agg(
        F.count("*").alias("_n"),
        F.min("_value").alias("_min"),
        F.max("_value").alias("_max"),
        F.percentile_approx("_value", [*low, *high], ACCURACY).alias("_edges"),
    )
    small = F.col("_n") <= ACCURACY

    def bracket(i: int, share: float) -> Column:
        position = F.lit(float(share)) * (F.col("_n") - 1)
        return F.struct(
            F.lit(float(share)).alias("share"),
            F.floor(position).alias("rank"),
            (position - F.floor(position)).alias("weight"),
            F.when(small, F.col("_min")).otherwise(F.col("_edges")[i]).alias("low"),
            F.when(small, F.col("_max")).otherwise(F.col("_edges")[len(shares) + i]).alias("high"),
        )

    return sketch.select(*keys, F.array(*[bracket(i, share) for i, share in enumerate(shares)]).alias("_brackets"))


def quantiles(df: DataFrame, keys: Sequence[str], value: str, shares: Sequence[float]) -> DataFrame:
    """Exact, linearly interpolated quantiles per group without gathering a group in one task.

    Sketches give each share a bracket of values around its ranks (see `brackets`). One more pass counts
    exactly: what lies below a bracket is a number, and only the values in it, equal ones together, are
    ordered: at most 6 / ACCURACY of a group's rows and its ties. Any scale of values will do.

    The brackets are stored first, a row per group: of known size, they go to the rows and not the rows of a group to
    one task. Runs the sketches.
    """
    measured = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_value"))
    edges = stored(brackets(measured, keys, shares), "brackets").withColumnsRenamed({key: f"_key_{key}" for key in keys})
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_key_{key}"))
    near = F.filter("_brackets", lambda b: F.col("_value") <= b["high"])
    placed = measured.join(edges, same).select(*keys, "_value", F.explode(near).alias("_at"))
    inside = F.when(F.col("_value") >= F.col("_at.low"), F.col("_value")).alias("_value")
    counts = placed.groupBy(*keys, "_at.share", "_at.rank", "_at.weight", inside).agg(F.count("*").alias("_n"))
    # What lies below has no value and comes first.
    by_value = Window.partitionBy(*keys, "share").orderBy("_value")
    upto = counts.withColumn("_upto", F.sum("_n").over(by_value)).filter(F.col("_value").isNotNull())
    first = (F.col("_upto") - F.col("_n") <= F.col("rank")) & (F.col("rank") < F.col("_upto"))
    after = F.col("rank") + 1
    second = (F.col("_upto") - F.col("_n") <= after) & (after < F.col("_upto")) & (F.col("weight") > 0)
    part = F.when(first, F.col("_value") * (1 - F.col("weight"))).otherwise(0.0) + F.when(second, F.col("_value") * F.col("weight")).otherwise(0.0)
    return upto.filter(first | second).groupBy(*keys, "share").agg(F.sum(part).alias("quantile"))


def compare_groups(
    df: DataFrame,
    group: str,
    value: str,
    threshold: float,
    digits: int = 4,
    decimals: int = 4,
) -> DataFrame:
    """Count, mean, share above and exact quartiles per group."""
    measured = df.filter(F.col(value).isNotNull())
    summary = measured.groupBy(group).agg(
        F.count(value).alias("n"),
        portable_round(exact_mean(F.col(value), decimals), digits).alias("mean"),
        portable_round(F.count_if(F.col(value) > threshold) / F.count(value), digits).alias(
            "share_above"
        ),
    )
    quartile = quantiles(measured, [group], value, [0.25, 0.5, 0.75])
    wide = quartile.groupBy(group).agg(
        *[
            portable_round(F.max(F.when(F.col("share") == share, F.col("quantile"))), digits).alias(name)
            for share, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))
        ]
    )
    return summary.join(wide, group)


def exceedance_summary(
    df: DataFrame, keys: Sequence[Column], value: str, flag: str, decimals: int = 2
) -> DataFrame:
    """Measured days, mean and share above of a daily table; NULL days do not count."""
    return df.groupBy(*keys).agg(
        F.count(value).alias("days_measured"),
        exact_mean(F.col(value), decimals).alias("mean"),
        F.sum(flag).alias("days_above"),
        F.try_divide(F.sum(flag), F.count(flag)).alias("share_above"),
    )

