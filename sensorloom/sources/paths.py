"""File names as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decoded(path: Column) -> Column:
    """A metadata path with its percent escapes undone; a plus sign is no escape."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def path_order(path: Column) -> Column:
    """An ordering key that compares paths component by component."""
    return F.split(path, "/")
