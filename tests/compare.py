"""Run registered queries and their oracle SQL side by side."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, decimal.Decimal):
        return round(float(value), 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def normalized(columns, rows):
    """Column names sorted, and the rows in that column order as a sorted list."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(cells, key=repr)


SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP",
}


def differences(df, con, sql: str) -> list[str]:
    """What differs between a Spark result and the oracle's; empty if nothing does."""
    found = con.execute(sql)
    want_columns = [d[0] for d in found.description]
    want_types = {d[0]: str(d[1]) for d in found.description}
    want = normalized(want_columns, found.fetchall())
    got = normalized(df.columns, [tuple(r) for r in df.collect()])
    problems = []
    if got[0] != want[0]:
        return [f"columns {got[0]} != {want[0]}"]
    for field in df.schema.fields:
        expected = SPARK_TO_DUCK.get(field.dataType.simpleString(), "?")
        if expected != want_types[field.name]:
            problems.append(
                f"type of {field.name}: {field.dataType.simpleString()} / {want_types[field.name]}"
            )
    if len(got[1]) != len(want[1]):
        problems.append(f"{len(got[1])} rows != {len(want[1])}")
    for a, b in zip(got[1], want[1]):
        if a != b:
            problems.append(f"row {a} != {b}")
            break
    return problems
