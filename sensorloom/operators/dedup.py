"""Keep-one-row-per-key operators.

No raw row is sorted. Rows compete in a hash aggregate over keys and one fixed-width number that orders
like the leading order columns; it is combined on the map side, so a key that holds a third of the rows
sends one number per task. The winners are joined back to the rows, broadcast where there are few, and only
rows that tie are ordered by what is left of the order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bits that a type's values and its NULL take. Times stay within 2^61 microseconds, 73,000 years.
BITS = {T.BooleanType: 2, T.ByteType: 9, T.ShortType: 17, T.IntegerType: 33, T.DateType: 33, T.LongType: 65, T.TimestampType: 62, T.TimestampNTZType: 62}
# A decimal of 38 digits, the widest buffer that a hash aggregate takes.
MOST_BITS, WIDE = 126, "decimal(38,0)"
SINGLE = (T.FloatType, T.DoubleType, T.DecimalType)


def fixed_width(kind: T.DataType) -> bool:
    """Whether a hash aggregate can hold values of the type."""
    return isinstance(kind, (*BITS, *SINGLE))


def wide(number: int) -> Column:
    return F.lit(str(number)).cast(WIDE)


def as_number(value: Column, kind: T.DataType) -> Column:
    """The value as a whole number above 0 in the order of values; NULL, which comes first, as 0."""
    if isinstance(kind, T.DateType):
        whole = F.unix_date(value)
    elif isinstance(kind, T.TimestampNTZType):
        # Microseconds of the clock, whatever the session's zone.
        whole = F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), value)
    elif isinstance(kind, T.TimestampType):
        whole = F.unix_micros(value)
    elif isinstance(kind, T.BooleanType):
        whole = value.cast("int")
    else:
        whole = value
    offset = 1 << (BITS[type(kind)] - 2)
    return F.coalesce(whole.cast(WIDE) + wide(offset + 1), wide(0))


def lead_of(df: DataFrame, order: Sequence[Column]) -> tuple[Column, int]:
    """A fixed-width column that orders like the leading order columns, and how many those are.

    One column stands for itself; several are packed into one number as long as they fit.
    """
    kinds = [field.dataType for field in df.select(*[c.alias(f"o{i}") for i, c in enumerate(order)]).schema]
    used, bits = 0, 0
    for kind in kinds:
        bits += BITS.get(type(kind), MOST_BITS + 1)
        if bits > MOST_BITS:
            break
        used += 1
    if used > 1:
        packed = as_number(order[0], kinds[0])
        for column, kind in zip(order[1:used], kinds[1:used], strict=True):
            packed = ((packed * wide(1 << BITS[type(kind)])).cast(WIDE) + as_number(column, kind)).cast(WIDE)
        return packed, used
    return order[0], int(bool(kinds) and fixed_width(kinds[0]))


def rows_with_least(df: DataFrame, keys: Sequence[str], lead: Column) -> DataFrame:
    """The rows of each key whose lead is least, NULL before all others."""
    winners = df.select(*keys, lead.alias("_lead")).groupBy(*[F.col(key).alias(f"_key_{key}") for key in keys])
    winners = winners.agg(F.min("_lead").alias("_least"), F.max(F.col("_lead").isNull()).alias("_none"))
    same = F.when(F.col("_none"), lead.isNull()).otherwise(lead == F.col("_least"))
    for key in keys:
        same = F.col(key).eqNullSafe(F.col(f"_key_{key}")) & same
    return df.join(winners, same).select(*df.columns)


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], unique_order: bool = False
) -> DataFrame:
    """The row of each key that comes first in the order.

    Ties fall back to the remaining columns, so the answer never depends on the physical order of
    rows. `unique_order` promises that one order column has no ties within a key; where all other
    columns are of fixed width, `min_by` then takes each of them in one hash aggregate.

    Rows are read twice, first only keys and order; an order that begins with text is compared as it
    is, by an aggregate that sorts.
    """
    rest = [name for name in df.columns if name not in keys]
    if unique_order and len(order) != 1:
        raise ValueError("unique_order needs exactly one order column")
    if unique_order and all(fixed_width(df.schema[name].dataType) for name in rest):
        picked = df.groupBy(*keys).agg(*[F.min_by(F.col(name), order[0]).alias(name) for name in rest])
        return picked.select(*df.columns)
    lead, covered = lead_of(df, order) if order else (None, 0)
    if not covered:
        return least_row(df, keys, order)
    first = rows_with_least(df, keys, lead)
    # The exchange of ties is its own, so that a join with a hot key can be split.
    return first if unique_order else least_row(first.repartition(*keys), keys, order)


def least_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The least row of each key by the order, then by all other columns."""
    rest = [name for name in df.columns if name not in keys]
    ranked = F.struct(
        *[column.alias(f"__o{i}") for i, column in enumerate(order)], *[F.col(name) for name in rest]
    )
    picked = df.groupBy(*keys).agg(F.min(ranked).alias("_first"))
    return picked.select(
        *[F.col(name) if name in keys else F.col("_first")[name].alias(name) for name in df.columns]
    )


def rank_of(value: Column, ranks: Mapping[str, int], unknown: int) -> Column:
    """The rank of a label; labels that are not listed, and NULL, get `unknown`."""
    result = F.lit(unknown)
    for label, rank in ranks.items():
        result = F.when(value == label, rank).otherwise(result)
    return result


def keep_preferred(
    df: DataFrame,
    keys: Sequence[str],
    label: str,
    ranks: Mapping[str, int],
    unknown: int,
    order: Sequence[Column] = (),
) -> DataFrame:
    """Of the rows of a key, the one whose label ranks best; then by `order`.

    Without an order of its own, rows compete by their content: equal rows meet in a hash aggregate
    first, and only different ones are compared.
    """
    rank = rank_of(F.col(label), ranks, unknown)
    return keep_first(df, keys, [rank, *order]) if order else least_row(df.distinct(), keys, [rank])


def first_seen(
    df: DataFrame, key: str, attributes: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """One row per key with the attributes it had when it was first seen."""
    placed = df.select(key, *[column.alias(f"_order_{i}") for i, column in enumerate(order)], *attributes)
    return keep_first(placed, [key], [F.col(f"_order_{i}") for i in range(len(order))]).select(key, *attributes)


def splice(
    df: DataFrame, keys: Sequence[str], station: str, preference: Sequence[str], source: str
) -> DataFrame:
    """one series out of several stations, with the station each row came from."""
    ranks = {code: rank for rank, code in enumerate(preference)}
    wanted = df.filter(F.col(station).isin(list(preference)))
    rank = rank_of(F.col(station), ranks, len(ranks))
    return keep_first(wanted, keys, [rank]).withColumnRenamed(station, source)
