"""Runs a registered query and its SQL on the same tables and compares the two."""

from __future__ import annotations

import datetime as dt
import math
import re
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from ebbtide.plans.oracle import all_sql
from ebbtide.plans.queries import all_queries


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


_KINDS = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP",
    "date": "DATE", "boolean": "BOOLEAN",
}


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(type(v)), v) for v in row))


def differences(spark: SparkSession, connection: duckdb.DuckDBPyConnection, name: str, folder: str) -> list[str]:
    """What differs between the two results; empty when they agree."""
    df = all_queries()[name](spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    if re.search(r"EvalPython|InPandas|CartesianProduct|NestedLoop", plan):
        return [f"the plan holds a Python step or a cross join: {plan}"]
    names = sorted(df.columns)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    left = _ordered([tuple(_plain(row[c]) for c in names) for row in df.collect()])
    relation = connection.sql(all_sql()[name])
    if sorted(relation.columns) != names:
        return [f"columns {names} against {sorted(relation.columns)}"]
    found = []
    sql_kinds = dict(zip(relation.columns, (str(t) for t in relation.types)))
    for c in names:
        if _KINDS.get(kinds[c]) != sql_kinds[c]:
            found.append(f"type of {c}: {kinds[c]} against {sql_kinds[c]}")
    listed = ", ".join(f'"{c}"' for c in names)
    right = _ordered([tuple(_plain(v) for v in row) for row in relation.project(listed).fetchall()])
    if len(left) != len(right):
        return [*found, f"{len(left)} rows against {len(right)}"]
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        a, b = wrong[0]
        cells = [(c, x, y) for c, x, y in zip(names, a, b) if x != y]
        found.append(f"{len(wrong)} rows differ, first in {cells[:6]}")
    return found
