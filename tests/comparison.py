"""Runs a registered query in Spark and its SQL in DuckDB, and compares the rows."""

from __future__ import annotations

import datetime as dt
import os
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def duckdb_connection(folder: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def _cell(value):
    if value is None or isinstance(value, (bool, str)):
        return value
    if isinstance(value, int):
        return value
    if isinstance(value, float):
        return ("float", round(value, 9))
    if isinstance(value, (dt.datetime, dt.date)):
        return str(value)
    return (type(value).__name__, str(value))


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    return Counter(tuple(_cell(row[at]) for at in order) for row in rows)


def differences(spark, build, sql: str, folder: str, connection) -> list[str]:
    frame = build(spark, folder)
    expected = connection.execute(sql)
    names = [column[0] for column in expected.description]
    if sorted(frame.columns) != sorted(names):
        return [f"columns: {sorted(frame.columns)} against {sorted(names)}"]
    ours = _rows(frame.columns, frame.collect())
    theirs = _rows(names, expected.fetchall())
    found = []
    if ours != theirs:
        found.append(f"rows: {sum(ours.values())} against {sum(theirs.values())}")
        found += [f"only Spark: {row} x{n}" for row, n in list((ours - theirs).items())[:3]]
        found += [f"only SQL: {row} x{n}" for row, n in list((theirs - ours).items())[:3]]
    if not theirs:
        found.append("no rows to compare")
    return found
