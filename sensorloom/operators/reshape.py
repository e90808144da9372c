"""Wide and long (B1, E9-E11) and the conformed projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def wide_to_long(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str
) -> DataFrame:
    """B1 for one schema: a row per filled cell."""
    return df.unpivot(list(ids), list(columns), name, value).filter(F.col(value).isNotNull())


def long_to_wide(
    df: DataFrame,
    keys: Sequence[str],
    code: str,
    measures: Mapping[str, tuple[str, Column]],
) -> DataFrame:
    """`{output: (code value, aggregated expression input)}` in one aggregate.

    A `pivot` would aggregate twice; conditional aggregates need one exchange and no extra job
    to find the values.
    """
    return df.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col(code) == wanted, measure)).alias(output)
            for output, (wanted, measure) in measures.items()
        ]
    )


def conform(df: DataFrame, schema: StructType, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Exactly the columns of the schema, in order; a missing one is NULL.

    `mapping` gives the input column of an output column.
    """
    mapping = mapping or {}
    columns = []
    for field in schema.fields:
        source = mapping.get(field.name, field.name)
        column = F.col(f"`{source}`") if source in df.columns else F.lit(None)
        columns.append(column.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def concatenate(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by name; columns only some inputs have are NULL in the rest."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
