"""Compare a query with its SQL, value by value."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


_KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
          "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def type_difference(frame, sql: str, connection) -> list[tuple]:
    """Columns whose type differs between the query and its SQL."""
    wanted = {r[0]: r[1] for r in connection.execute(f"DESCRIBE {sql}").fetchall()}
    return [(c, t, wanted.get(c)) for c, t in frame.dtypes if _KINDS.get(t) != wanted.get(c)]


def difference(frame, sql: str, connection) -> str | None:
    """None where rows and columns agree, else a short description."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    wanted = _bag(names, result.fetchall())
    got_rows = frame.collect()
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    got = _bag(frame.columns, got_rows)
    if got != wanted:
        return (f"{sum(got.values())} rows, {sum(wanted.values())} expected; "
                f"extra {list((got - wanted).items())[:3]}, "
                f"missing {list((wanted - got).items())[:3]}")
    return None
