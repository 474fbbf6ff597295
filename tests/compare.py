"""Run a registered query and its SQL on the same tables and compare all values."""

from __future__ import annotations

import glob
import math
import os

import duckdb

TESTDATA = os.environ.get("PARCELWISE_TESTDATA", "/root/testdata")


def open_tables(folder: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


SAME = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "float": "FLOAT",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return repr(value)


def compare(con, sql: str, df) -> list[str]:
    """Differences found; empty when columns, types and all values agree."""
    result = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in result.description}
    names = [d[0] for d in result.description]
    order = sorted(names)
    if sorted(df.columns) != order:
        return [f"columns {sorted(df.columns)} != {order}"]
    problems = []
    for name, kind in df.dtypes:
        if SAME.get(kind, kind) != theirs[name]:
            problems.append(f"type of {name}: {kind} != {theirs[name]}")
    expected = sorted(
        tuple(_cell(row[names.index(c)]) for c in order) for row in result.fetchall()
    )
    table = df.select(*order).toArrow().to_pylist() if df.columns else []
    found = sorted(tuple(_cell(row[c]) for c in order) for row in table)
    if len(found) != len(expected):
        problems.append(f"rows {len(found)} != {len(expected)}")
    differing = [(a, b) for a, b in zip(found, expected) if a != b]
    if differing:
        a, b = differing[0]
        shown = {c: (x, y) for c, x, y in zip(order, a, b) if x != y}
        problems.append(f"{len(differing)} rows differ, first: {shown}")
    return problems
