"""Compare a registered query with its SQL twin."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if hasattr(value, "asDict"):
        return tuple(sorted((k, _plain(v)) for k, v in value.asDict().items()))
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def differences(df, connection, sql: str, shown: int = 5) -> list[str]:
    """What differs between a DataFrame and the result of a statement, in words."""
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    found = _rows(df.columns, df.collect())
    wanted = _rows(names, expected)
    report = []
    if len(found) != len(wanted):
        report.append(f"{len(found)} rows != {len(wanted)}")
    # repr also tells 1 from 1.0, so types are compared as well.
    left, right = Counter(map(repr, found)), Counter(map(repr, wanted))
    report += [f"more often in spark: {row}" for row in sorted(left - right)[:shown]]
    report += [f"more often in sql:   {row}" for row in sorted(right - left)[:shown]]
    return report
